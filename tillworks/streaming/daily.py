"""Daily sales as lines arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks import schemas
from tillworks.functions import columns as C
from tillworks.operators.silver import sale_lines
from tillworks.sources.layers import LayerStore, in_partitions
from tillworks.streaming import landing

DAILY = "silver.daily_sales"


def daily_sales(bronze: DataFrame) -> DataFrame:
    """Sales per (day, stock code, country); COUNT DISTINCT spreads a hot group over its invoices."""
    return (
        sale_lines(bronze)
        .where(F.col("invoicedate").isNotNull())
        .groupBy(
            F.to_date("invoicedate").alias("date"), F.col("stockcode").alias("stock_code"), "country"
        )
        .agg(
            F.max(C.parse_customer_id("customerid")).alias("customer_id"),
            F.countDistinct("invoiceno").alias("total_transactions"),
            C.count_sum("quantity").alias("total_quantity"),
            C.line_revenue().alias("total_revenue"),
        )
        .withColumn("invoice_month", F.date_format("date", "yyyy-MM"))
    )


def refresh_days(store: LayerStore, rows: DataFrame, batch: str) -> None:
    """Take one batch of lines into bronze and rebuild the days of the months it touches.

    Days are rebuilt from all their lines, so the end state does not depend on
    how files fall into batches, late lines count, and no state is kept between
    batches.
    """
    touched = landing.touched_months(landing.take_batch(store, rows, batch))
    if touched:
        lines = store.read(landing.BRONZE).where(in_partitions(touched, ["invoice_month"]))
        store.overwrite_partitions(daily_sales(lines).select(*schemas.DAILY_SALES.names), DAILY)


def stream_daily_sales(lines: DataFrame, store: LayerStore, checkpoint: str) -> None:
    """Drain a stream of bronze lines into the daily sales of the store."""
    landing.drain(lines, checkpoint, lambda rows, batch: refresh_days(store, rows, batch))
