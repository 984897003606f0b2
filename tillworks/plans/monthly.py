"""Incremental monthly refresh with a ledger, and its siblings."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tillworks.functions import rules
from tillworks.operators import ledger as L
from tillworks.operators import oplog
from tillworks.operators import sales_marts as SM
from tillworks.session import durable
from tillworks.sources.layers import LayerStore

MONTHS, CHECKPOINTS, LOGS = "ops.processed_months", "ops.pipeline_checkpoint", "ops.pipeline_logs"
MONTHLY = "gold.fact_sales_monthly"


def reset_ledger(store: LayerStore, name: str = MONTHS) -> None:
    store.replace(store.empty(name), name)


def mark(store: LayerStore, months: DataFrame, status: str) -> None:
    """Put months into a status in the ledger table."""
    store.upsert(L.month_rows(months, status), MONTHS, L.MONTH_KEY)


def pending(store: LayerStore, year: int | None = None, month: int | None = None) -> DataFrame:
    months = L.distinct_months(store.read("silver.fact_sales_daily"))
    return L.pending_months(months, store.read_or_empty(MONTHS), year, month)


def _months_frame(store: LayerStore, months: Sequence[tuple[int, int]]) -> DataFrame:
    return store.spark.createDataFrame([tuple(m) for m in months], "year int, month int")


def recompute(store: LayerStore, months: Sequence[tuple[int, int]]) -> None:
    """Rebuild the monthly rows of the given months, leaving the others.

    The month list comes from the ledger and is bounded by the calendar, as is the
    mart (one row per month): a keyed upsert rewrites one small file, where a
    folder per month would hold a single row each.
    """
    fact, dates = store.read("silver.fact_sales_daily"), store.read("silver.dim_date")
    rows = L.recompute_months(fact, dates, months, store.count_unknown)
    store.upsert(rows, MONTHLY, ["year", "month"])


def refresh_months(
    store: LayerStore, year: int | None = None, month: int | None = None, dry_run: bool = False
) -> list[tuple[int, int]]:
    """Process every pending month in one job; returns the months.

    All pending months are aggregated together instead of one query per month.
    A failure leaves them marked failed, so the next run takes them again.
    """
    months = [
        (r["year"], r["month"])
        for r in pending(store, year, month).orderBy("year", "month").collect()
    ]
    if dry_run or not months:
        return months
    frame = _months_frame(store, months)
    mark(store, frame, rules.IN_PROGRESS)
    try:
        recompute(store, months)
    except Exception:
        mark(store, frame, rules.FAILED)
        raise
    mark(store, frame, rules.COMPLETED)
    return months


def repair(store: LayerStore, clean_months: Sequence[tuple[int, int]]) -> None:
    """Copy the ledger aside, drop damaged rows, enter the clean months as completed."""
    ledger = store.read(MONTHS)
    store.append(ledger, "ops.processed_months_backup", [])
    store.replace(L.repair_ledger(ledger, _months_frame(store, clean_months)), MONTHS)


def append_log(store: LayerStore, rows: DataFrame) -> None:
    store.append(rows, LOGS)


def recover_logs(store: LayerStore, path: str) -> tuple[int, DataFrame]:
    """Append fallback log lines to the log table; returns the count and the unreadable lines.

    Lines that the table has already (run, time, level and message) are left out, so a
    second recovery of a file adds nothing.
    """
    rows, unreadable = oplog.recover_logs(store.spark, path)
    before = store.read_or_empty(LOGS)
    fresh = durable(oplog.absent_rows(before, rows))
    store.append(fresh, LOGS)
    return fresh.count(), unreadable


def refresh_marts(
    store: LayerStore, pipeline_name: str = "gold_refresh", run_id: str | None = None
) -> str:
    """Product and country marts with stage checkpoints and logs; returns the run id.

    A stage that this run already completed is skipped, so a run can be resumed
    under its id. A failed stage is recorded as failed.
    """
    run_id = run_id or str(uuid.uuid4())

    def log(level: str, message: str, **metadata) -> None:
        text = json.dumps(metadata) if metadata else None
        append_log(
            store, oplog.log_rows(store.spark, pipeline_name, run_id, [(level, message)], text)
        )

    def save(checkpoints: DataFrame) -> None:
        store.replace(checkpoints, CHECKPOINTS)

    def stage(name: str, table: str, keys: Sequence[str], rows: DataFrame) -> None:
        key = (pipeline_name, run_id, name, "end")
        if L.get_checkpoint(store.read_or_empty(CHECKPOINTS), key) == rules.COMPLETED:
            return
        save(L.start_stage(store.read_or_empty(CHECKPOINTS), key))
        began = time.monotonic()
        try:
            store.upsert(rows, table, keys)
        except Exception as error:
            save(L.set_checkpoint(store.read(CHECKPOINTS), key, rules.FAILED, rules.FAILED))
            log("ERROR", f"{name} failed: {error}")
            raise
        took = int((time.monotonic() - began) * 1000)
        updated = store.read(table).count()
        note = json.dumps({"rows_updated": updated, "duration_ms": took})
        save(L.set_checkpoint(
            store.read(CHECKPOINTS), key, rules.COMPLETED, metadata=note, duration_ms=took
        ))
        log("INFO", f"{name}: {updated} rows")

    fact, dates = store.read("silver.fact_sales_daily"), store.read("silver.dim_date")
    products = store.read("silver.dim_product")
    log("INFO", "started", run_id=run_id)
    stage(
        "product_performance", "gold.fact_product_performance", ["product_id"],
        SM.product_performance(fact, products, dates),
    )
    stage(
        "country_sales", "gold.fact_country_sales", ["country"],
        SM.country_sales(fact, dates, store.count_unknown),
    )
    log("INFO", "finished", run_id=run_id)
    return run_id
