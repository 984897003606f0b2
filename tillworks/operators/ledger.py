"""Month and date ledgers, stage checkpoints: frames in, frames out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import schemas
from tillworks.functions import columns as C
from tillworks.functions import rules
from tillworks.operators.merge import insert_absent, upsert
from tillworks.operators.sales_marts import sales_monthly

MONTH_KEY = ["month_key"]
DATE_KEY = ["date_value"]
CHECKPOINT_KEY = ["pipeline_name", "run_id", "stage", "checkpoint_key"]


def _now() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


# --- months -----------------------------------------------------------------


def distinct_months(fact: DataFrame) -> DataFrame:
    """(year, month) that have facts.

    Both are storage folders of the fact, taken from the date dimension when it
    was built: a scan reads no column, only file footers.
    """
    return fact.select("year", "month").distinct()


def pending_months(
    months: DataFrame, ledger: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Months still to do: all, one year's, or one given month whether it has facts or not.

    Only completed months count as done, so a month left in progress by a dead
    run is picked up again.
    """
    if year and month:
        months = months.sparkSession.range(1).select(
            F.lit(year).alias("year"), F.lit(month).alias("month")
        )
    elif year:
        months = months.where(F.col("year") == year)
    done = ledger.where(F.col("status") == rules.COMPLETED).select("month_key")
    keyed = months.select("year", "month", C.month_key("year", "month").alias("month_key"))
    return keyed.join(done, "month_key", "left_anti").select("year", "month", "month_key")


def month_rows(months: DataFrame, status: str, metadata: str | None = None) -> DataFrame:
    """Ledger rows that put (year, month) into a status."""
    return months.select(
        C.month_key("year", "month").alias("month_key"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        _now().alias("processed_at"),
        _now().alias("updated_at"),
        F.lit(status).alias("status"),
        F.lit(metadata).cast("string").alias("metadata"),
    )


def mark_months(ledger: DataFrame, months: DataFrame, status: str) -> DataFrame:
    return upsert(ledger, month_rows(months, status), MONTH_KEY)


def mark_month(ledger: DataFrame, year: int, month: int, status: str) -> DataFrame:
    one = ledger.sparkSession.range(1).select(F.lit(year).alias("year"), F.lit(month).alias("month"))
    return mark_months(ledger, one, status)


def mark_date(ledger: DataFrame, date_value: str, status: str) -> DataFrame:
    row = ledger.sparkSession.range(1).select(
        F.lit(date_value).alias("date_value"), _now().alias("processed_at"),
        F.lit(status).alias("status"),
    )
    return upsert(ledger, row, DATE_KEY)


def recompute_months(
    fact: DataFrame, dates: DataFrame, months: Sequence[tuple[int, int]], count_unknown: bool = True
) -> DataFrame:
    """Monthly rows of the given months only.

    The list becomes a literal predicate on both inputs: the fact's year and
    month are its storage partitions, so other months are not read.
    """
    keep = (F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in months])
    return sales_monthly(fact.where(keep), dates.where(keep), count_unknown)


def rebuild_months_from_daily(
    daily: DataFrame, months: Sequence[str] | None = None
) -> DataFrame:
    """Sums per 'YYYY-MM' (the given ones, or all) from daily rows with a DATE date_id.

    The months become a range on the date itself, which Parquet statistics can
    prune, where a predicate on the formatted text could not.
    """
    if months is not None:
        keep = F.lit(False)
        for m in months:
            first = F.lit(f"{m}-01").cast("date")
            keep = keep | ((F.col("date_id") >= first) & (F.col("date_id") < F.add_months(first, 1)))
        daily = daily.where(keep)
    return daily.groupBy(
        F.date_format("date_id", "yyyy-MM").alias("month_key"),
        F.year("date_id").alias("year"),
        F.month("date_id").alias("month"),
    ).agg(
        C.money_sum("total_sales").alias("total_sales"),
        C.count_sum("total_quantity").alias("total_quantity"),
        C.count_sum("transaction_count").alias("transaction_count"),
    )


# --- damage and repair ------------------------------------------------------


def scan_ledger(ledger: DataFrame) -> DataFrame:
    """Ledger rows with three damage flags: metadata, status, year or month."""
    parsed = F.try_parse_json("metadata")
    return ledger.select(
        *[c for c in ledger.columns if c != "metadata"],
        (F.col("metadata").isNotNull() & parsed.isNull()).alias("bad_metadata"),
        (~F.coalesce(F.col("status").isin(rules.LEDGER_STATUSES), F.lit(False))).alias("bad_status"),
        (F.col("year").isNull() | F.col("month").isNull()).alias("missing_month"),
    )


def _damaged() -> Column:
    metadata = F.col("metadata")
    unreadable = metadata.isNotNull() & F.try_parse_json("metadata").isNull()
    marked = F.coalesce(F.lower(metadata).contains("corrupted"), F.lit(False))
    bad_status = ~F.coalesce(F.col("status").isin(rules.LEDGER_STATUSES), F.lit(False))
    return unreadable | marked | bad_status | F.col("year").isNull() | F.col("month").isNull()


def healthy_rows(ledger: DataFrame) -> DataFrame:
    """Ledger without damaged rows."""
    return ledger.where(~_damaged())


def repair_ledger(ledger: DataFrame, clean_months: DataFrame) -> DataFrame:
    """Healthy rows plus the given (year, month) as completed; keep a copy first."""
    recovered = month_rows(clean_months, rules.COMPLETED, '{"recovered": true}')
    return upsert(healthy_rows(ledger), recovered, MONTH_KEY)


# --- stage checkpoints ------------------------------------------------------


def _checkpoint_row(spark, key: Sequence[str], **values) -> DataFrame:
    fields = dict(zip(CHECKPOINT_KEY, key)) | values
    cols = []
    for f in schemas.PIPELINE_CHECKPOINT.fields:
        v = fields.get(f.name)
        cols.append((v if isinstance(v, Column) else F.lit(v)).cast(f.dataType).alias(f.name))
    return spark.range(1).select(*cols)


def _is_key(key: Sequence[str]) -> Column:
    same = F.lit(True)
    for name, part in zip(CHECKPOINT_KEY, key):
        same = same & (F.col(name) == part)
    return same


def start_stage(checkpoints: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add an in-progress row unless the key (pipeline, run, stage, key) exists."""
    row = _checkpoint_row(
        checkpoints.sparkSession, key, status=rules.IN_PROGRESS, start_time=_now(),
        created_at=_now(), updated_at=_now(),
    )
    return insert_absent(checkpoints, row, CHECKPOINT_KEY)


def set_checkpoint(
    checkpoints: DataFrame, key: Sequence[str], value: str, status: str = rules.COMPLETED,
    metadata: str | None = None, duration_ms: int = 0,
) -> DataFrame:
    """Upsert a checkpoint; an existing row keeps its start and creation time."""
    old = checkpoints.where(_is_key(key)).agg(
        F.min("start_time").alias("old_start"), F.min("created_at").alias("old_created")
    )
    row = _checkpoint_row(
        checkpoints.sparkSession, key, checkpoint_value=value, status=status,
        start_time=F.coalesce(old.select("old_start").scalar(), _now()), end_time=_now(),
        duration_ms=duration_ms, metadata=metadata,
        created_at=F.coalesce(old.select("old_created").scalar(), _now()), updated_at=_now(),
    )
    return upsert(checkpoints, row, CHECKPOINT_KEY)


def get_checkpoint(checkpoints: DataFrame, key: Sequence[str]) -> str | None:
    found = checkpoints.where(_is_key(key)).select("checkpoint_value").head()
    return found[0] if found else None
