"""Table contracts: column names and types are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
_TS, _B = T.TimestampNTZType(), T.BooleanType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The source file is text on purpose: cleaning decides what a bad value means,
# a typed CSV reader would turn it into NULL unseen.
SOURCE_FILE = _struct(
    ("InvoiceNo", _S), ("StockCode", _S), ("Description", _S), ("Quantity", _S),
    ("InvoiceDate", _S), ("UnitPrice", _S), ("CustomerID", _S), ("Country", _S),
)

BRONZE_LINE = _struct(
    ("invoiceno", _S), ("stockcode", _S), ("description", _S), ("quantity", _I),
    ("invoicedate", _TS), ("unitprice", T.DecimalType(10, 2)), ("customerid", _S),
    ("country", _S),
)
BRONZE_TABLE = T.StructType(
    BRONZE_LINE.fields
    + _struct(
        ("ingested_at", _TS), ("source_file", _S), ("ingest_batch", _S), ("invoice_month", _S)
    ).fields
)

DIM_DATE = _struct(
    ("date_id", _I), ("date", _D), ("day", _I), ("day_name", _S), ("day_of_week", _I),
    ("month", _I), ("month_name", _S), ("quarter", _I), ("year", _I),
    ("is_weekend", _B), ("is_holiday", _B),
)
DIM_PRODUCT = _struct(
    ("product_id", _L), ("stock_code", _S), ("description", _S), ("category", _S),
)
FACT_SALES_DAILY = _struct(
    ("date_id", _I), ("product_id", _L), ("country", _S), ("customer_id", _L),
    ("total_transactions", _L), ("total_quantity", _L),
    ("total_revenue", T.DecimalType(15, 2)), ("avg_unit_price", T.DecimalType(14, 6)),
    ("year", _I), ("month", _I),
)

DAILY_SALES = _struct(
    ("date", _D), ("stock_code", _S), ("country", _S), ("customer_id", _L),
    ("total_transactions", _L), ("total_quantity", _L), ("total_revenue", T.DecimalType(18, 2)),
    ("invoice_month", _S),
)

PROCESSED_MONTHS = _struct(
    ("month_key", _S), ("year", _I), ("month", _I), ("processed_at", _TS),
    ("updated_at", _TS), ("status", _S), ("metadata", _S),
)
PROCESSED_DATES = _struct(("date_value", _S), ("processed_at", _TS), ("status", _S))
PIPELINE_CHECKPOINT = _struct(
    ("pipeline_name", _S), ("run_id", _S), ("stage", _S), ("checkpoint_key", _S),
    ("checkpoint_value", _S), ("status", _S), ("start_time", _TS), ("end_time", _TS),
    ("duration_ms", _I), ("metadata", _S), ("created_at", _TS), ("updated_at", _TS),
)
PIPELINE_LOGS = _struct(
    ("timestamp", _TS), ("level", _S), ("message", _S), ("logger", _S),
    ("pipeline_name", _S), ("run_id", _S), ("module", _S), ("function", _S),
    ("line", _I), ("metadata", _S),
)

# Longest text each bronze column may hold.
BRONZE_TEXT_LIMITS = {
    "invoiceno": 10, "stockcode": 20, "description": 255, "customerid": 10, "country": 100,
}

TABLES = {
    "bronze.raw_transactions": BRONZE_TABLE,
    "silver.dim_date": DIM_DATE,
    "silver.dim_product": DIM_PRODUCT,
    "silver.fact_sales_daily": FACT_SALES_DAILY,
    "silver.daily_sales": DAILY_SALES,
    "ops.processed_months": PROCESSED_MONTHS,
    "ops.processed_dates": PROCESSED_DATES,
    "ops.pipeline_checkpoint": PIPELINE_CHECKPOINT,
    "ops.pipeline_logs": PIPELINE_LOGS,
}
PARTITIONED_BY = {
    "bronze.raw_transactions": ["ingest_batch", "invoice_month"],
    "silver.fact_sales_daily": ["year", "month"],
    "silver.daily_sales": ["invoice_month"],
}
