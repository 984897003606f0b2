"""Invoice-line files: reading, column names, the two cleaning variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import schemas
from tillworks.functions import rules
from tillworks.sources import workbooks

# Date layouts of the source files; day comes first.
DATE_FORMATS = ["dd/MM/yyyy H:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]

_KEYS = ["invoiceno", "stockcode", "invoicedate"]


def read_transactions(
    spark: SparkSession, path: str, fmt: str = "csv", sheets: str | Sequence[str] = workbooks.FIRST
) -> DataFrame:
    """Invoice lines from a file or folder on any Hadoop file system.

    CSV is read as text under the fixed schema, never inferred; Parquet keeps
    its own types. Workbooks (xlsx) give text, from their first sheet, from "all"
    or from named ones. ``source_file`` is the path each row came from.
    """
    if fmt == "xlsx":
        return workbooks.read_workbooks(spark, path, schemas.SOURCE_FILE.names, sheets)
    if fmt == "csv":
        lines = (
            spark.read.schema(schemas.SOURCE_FILE)
            .option("header", True)
            .option("enforceSchema", False)
            .option("multiLine", False)
            .csv(path)
        )
    elif fmt == "parquet":
        lines = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")
    return lines.withColumn("source_file", F.col("_metadata.file_path"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case column names without spaces."""
    return df.toDF(*[c.lower().replace(" ", "") for c in df.columns])


def _parsed_date(df: DataFrame, formats: Sequence[str]) -> Column:
    """Timestamp of a text column by the first layout that fits, else NULL."""
    if not isinstance(df.schema["invoicedate"].dataType, T.StringType):
        return F.col("invoicedate").cast("timestamp_ntz")
    tries = [F.try_to_timestamp(F.col("invoicedate"), F.lit(f)) for f in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def _number(name: str) -> Column:
    """Column as a double; NaN counts as missing, text that is no number raises."""
    return F.nullif(F.col(name).cast("double"), F.lit(float("nan")))


def _customer_text() -> Column:
    """Customer as text; a missing one of a float column reads 'nan'."""
    c = F.col("customerid").cast("string")
    return F.when(F.lower(c) != "nan", c)


def _bronze_line(df: DataFrame) -> DataFrame:
    extra = [c for c in df.columns if c == "source_file"]
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.BRONZE_LINE.fields],
        *extra,
    )


def clean_strict(df: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Rows fit for bronze.

    Drops rows without invoice, stock code or a readable date, fills description,
    quantity and price, keeps prices within the limits. The price is compared
    before it is rounded to cents. An empty customer becomes NULL; so does an
    empty country, which the fact then leaves out.
    """
    raw = normalize_columns(df)
    return _bronze_line(
        raw.withColumn("invoicedate", _parsed_date(raw, formats))
        .dropna(subset=_KEYS)
        .withColumn("unitprice", F.coalesce(_number("unitprice"), F.lit(0.0)))
        .where(F.col("unitprice").between(rules.MIN_PRICE, rules.MAX_PRICE))
        .withColumn("description", F.coalesce("description", F.lit(rules.STRICT_DESCRIPTION)))
        .withColumn("quantity", F.coalesce(_number("quantity").cast("int"), F.lit(0)))
        .withColumn("customerid", _customer_text())
    )


def cleaning_report(df: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """What ``clean_strict`` does to a file, one row: lines read, dropped by reason, kept."""
    raw = normalize_columns(df)
    no_key = F.col("invoiceno").isNull() | F.col("stockcode").isNull() | F.col("invoicedate").isNull()
    price = F.coalesce(_number("unitprice"), F.lit(0.0))
    fate = (
        F.when(no_key, "missing_key")
        .when(_parsed_date(raw, formats).isNull(), "unreadable_date")
        .when(~price.between(rules.MIN_PRICE, rules.MAX_PRICE), "invalid_price")
        .otherwise("kept")
    )
    return raw.select(fate.alias("fate")).agg(
        F.count(F.lit(1)).alias("read_rows"),
        *[
            F.count_if(F.col("fate") == f).alias(f"{f}_rows")
            for f in ["missing_key", "unreadable_date", "invalid_price", "kept"]
        ],
    )


def clean_lenient(df: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Object-store variant: fills text, keeps null keys, no upper price limit.

    A quantity that is missing or no number, a price that is no number and a
    date that is there but unreadable fail the job.
    """
    raw = normalize_columns(df)
    when = _parsed_date(raw, formats)
    bad_date = F.raise_error(F.concat(F.lit("unreadable date: "), F.col("invoicedate")))
    no_quantity = F.raise_error(F.lit("quantity is missing")).cast("int")
    return _bronze_line(
        raw.withColumn(
            "invoicedate",
            F.when(when.isNull() & F.col("invoicedate").isNotNull(), bad_date).otherwise(when),
        )
        .withColumn("unitprice", _number("unitprice"))
        .where((F.col("unitprice") >= rules.MIN_PRICE) | F.col("unitprice").isNull())
        .withColumn("description", F.coalesce("description", F.lit(rules.LENIENT_DESCRIPTION)))
        .withColumn("customerid", F.coalesce(_customer_text(), F.lit("")))
        .withColumn("quantity", F.coalesce(_number("quantity").cast("int"), no_quantity))
    )


def bronze_rows(df: DataFrame, batch: str, source_file: str | None = None) -> DataFrame:
    """Cleaned lines with the writer's columns.

    ``source_file`` overrides the path the reader noted. ``invoice_month`` and
    ``ingest_batch`` are the storage partitions.
    """
    if source_file is not None:
        df = df.withColumn("source_file", F.lit(source_file))
    elif "source_file" not in df.columns:
        df = df.withColumn("source_file", F.lit(None).cast("string"))
    return df.select(
        *[f.name for f in schemas.BRONZE_LINE.fields],
        F.current_timestamp().cast("timestamp_ntz").alias("ingested_at"),
        "source_file",
        F.lit(batch).alias("ingest_batch"),
        F.coalesce(F.date_format("invoicedate", "yyyy-MM"), F.lit("unknown")).alias(
            "invoice_month"
        ),
    )
