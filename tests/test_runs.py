import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from frames import D, rows
from tillworks import schemas
from tillworks.operators import ledger as L
from tillworks.operators import oplog
from tillworks.operators import sales_marts as SM
from tillworks.plans import medallion, monthly

CSV = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
1,A1,alpha,6,01/12/2010 8:26,2.55,17850,UK
1,B2,beta,2,01/12/2010 8:26,1.00,17850,UK
C2,A1,alpha,-6,02/12/2010 9:00,2.55,17850,UK
3,A1,alpha,1,05/01/2011 9:00,2.55,,France
,A1,alpha,1,05/01/2011 9:00,2.55,,France
4,POST,postage,1,06/01/2011 9:00,20000,12345.0,France
"""


@pytest.fixture
def layers(spark, store, tmp_path):
    (tmp_path / "in.csv").write_text(CSV)
    checks = medallion.run(spark, str(tmp_path / "in.csv"), store.root, as_of="2011-02-01")
    return store, checks


def test_batch_run(spark, layers, tmp_path):
    store, checks = layers
    assert checks.where("NOT passed").count() == 0
    assert store.read("bronze.raw_transactions").count() == 4
    assert sorted(rows(store.read("silver.dim_product"), "product_id", "stock_code")) == [(1, "A1"), (2, "B2")]
    assert sorted(rows(store.read("gold.fact_sales_monthly"), "year", "month", "total_revenue")) == [
        (2010, 12, D("17.30")), (2011, 1, D("2.55"))
    ]
    before = {n: sorted(map(str, rows(store.read(f"gold.{n}")))) for n in medallion.gold_models()}
    medallion.run(spark, str(tmp_path / "in.csv"), store.root, as_of="2011-02-01")
    after = {n: sorted(map(str, rows(store.read(f"gold.{n}")))) for n in medallion.gold_models()}
    assert before == after and store.read("bronze.raw_transactions").count() == 4


def test_lenient_run_fails_on_what_strict_drops(spark, store, tmp_path):
    (tmp_path / "bad.csv").write_text(CSV + "9,A1,alpha,many,05/01/2011 9:00,2.55,,France\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        medallion.run(spark, str(tmp_path / "bad.csv"), store.root, cleaning="lenient")
    assert not store.exists("bronze.raw_transactions")


def test_upsert_fact(spark, layers):
    store, _ = layers
    fact = store.read("silver.fact_sales_daily")
    change = fact.where("year = 2011").withColumn("total_quantity", F.lit(99).cast("bigint"))
    medallion.upsert_fact(store, change.unionByName(change.withColumn("country", F.lit("Spain"))))
    got = sorted(rows(store.read("silver.fact_sales_daily"), "date_id", "country", "total_quantity"))
    assert got == [(20101201, "UK", 2), (20101201, "UK", 6), (20110105, "France", 99), (20110105, "Spain", 99)]


def test_month_by_month_equals_all_at_once(spark, layers):
    store, _ = layers
    fact, dates = store.read("silver.fact_sales_daily"), store.read("silver.dim_date")
    months = [tuple(r) for r in L.distinct_months(fact).collect()]
    assert sorted(months) == [(2010, 12), (2011, 1)]
    single = [L.recompute_months(fact, dates, [m]).head() for m in sorted(months)]
    assert single == SM.sales_monthly(fact, dates, count_unknown=True).orderBy("year", "month").collect()


def test_refresh_months(spark, layers):
    store, _ = layers
    store.replace(store.read("gold.fact_sales_monthly").where("false"), "gold.fact_sales_monthly")
    assert monthly.refresh_months(store, dry_run=True) == [(2010, 12), (2011, 1)]
    assert not store.exists("ops.processed_months")
    assert monthly.refresh_months(store, year=2010) == [(2010, 12)]
    assert monthly.refresh_months(store) == [(2011, 1)]
    assert monthly.refresh_months(store) == []
    done = rows(store.read("ops.processed_months").orderBy("month_key"), "month_key", "status")
    assert done == [("2010-12", "completed"), ("2011-01", "completed")]
    first = sorted(rows(store.read("gold.fact_sales_monthly")))
    monthly.reset_ledger(store)
    assert monthly.refresh_months(store) == [(2010, 12), (2011, 1)]
    assert sorted(rows(store.read("gold.fact_sales_monthly"))) == first
    # one given month is taken even when it has no facts
    assert monthly.refresh_months(store, year=2012, month=3) == [(2012, 3)]
    assert sorted(rows(store.read("gold.fact_sales_monthly"))) == first


def test_a_failed_month_is_taken_again(spark, layers, monkeypatch):
    store, _ = layers

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(monthly, "recompute", fail)
        with pytest.raises(RuntimeError):
            monthly.refresh_months(store)
    assert {r[0] for r in rows(store.read("ops.processed_months"), "status")} == {"failed"}
    monthly.mark(store, spark.createDataFrame([(2010, 12)], "year int, month int"), "in_progress")
    assert monthly.refresh_months(store) == [(2010, 12), (2011, 1)]


def _ledger(spark, *data):
    now = dt.datetime(2024, 1, 1)
    full = [(k, y, m, now, now, s, meta) for k, y, m, s, meta in data]
    return spark.createDataFrame(full, schemas.PROCESSED_MONTHS)


DAMAGED = [
    ("2010-12", 2010, 12, "completed", '{"invalid": json, "corrupted": true}'),
    ("2011-01", 2011, 1, "invalid_status_corrupted", None),
    ("2011-02", None, None, "completed", None),
    ("2011-03", 2011, 3, "failed", '{"note": "fine"}'),
    ("2011-04", 2011, 4, "completed", '{"state": "Corrupted"}'),
    ("2011-05", 2011, 5, None, None),
]


def test_scan_ledger(spark):
    got = {r["month_key"]: (r["bad_metadata"], r["bad_status"], r["missing_month"])
           for r in L.scan_ledger(_ledger(spark, *DAMAGED)).collect()}
    assert got == {
        "2010-12": (True, False, False), "2011-01": (False, True, False), "2011-02": (False, False, True),
        "2011-03": (False, False, False), "2011-04": (False, False, False), "2011-05": (False, True, False),
    }


def test_repair(spark, store):
    store.replace(_ledger(spark, *DAMAGED), "ops.processed_months")
    monthly.repair(store, [(2010, 12), (2011, 1)])
    got = sorted(rows(store.read("ops.processed_months"), "month_key", "status", "metadata"))
    assert got == [
        ("2010-12", "completed", '{"recovered": true}'), ("2011-01", "completed", '{"recovered": true}'),
        ("2011-03", "failed", '{"note": "fine"}'),
    ]
    assert store.read("ops.processed_months_backup").count() == len(DAMAGED)


def test_mark_and_dates(spark):
    ledger = L.mark_month(spark.createDataFrame([], schemas.PROCESSED_MONTHS), 2011, 1, "in_progress")
    ledger = L.mark_month(ledger, 2011, 1, "completed")
    assert rows(ledger, "month_key", "year", "month", "status") == [("2011-01", 2011, 1, "completed")]
    dates = L.mark_date(spark.createDataFrame([], schemas.PROCESSED_DATES), "2011-01-02", "in_progress")
    dates = L.mark_date(L.mark_date(dates, "2011-01-02", "completed"), "2011-01-03", "completed")
    assert sorted(rows(dates, "date_value", "status")) == [("2011-01-02", "completed"), ("2011-01-03", "completed")]


def test_rebuild_months(spark):
    daily = spark.createDataFrame(
        [(dt.date(2010, 12, 1), D("1.50"), 2, 1), (dt.date(2010, 12, 31), D("2.00"), 1, 1),
         (dt.date(2011, 1, 1), D("4.00"), 5, 3)],
        "date_id date, total_sales decimal(12,2), total_quantity int, transaction_count int",
    )
    assert rows(L.rebuild_months_from_daily(daily, ["2010-12"])) == [("2010-12", 2010, 12, D("3.50"), 3, 2)]
    assert L.rebuild_months_from_daily(daily).count() == 2


def test_checkpoints(spark):
    key = ("p", "r", "load", "end")
    none = spark.createDataFrame([], schemas.PIPELINE_CHECKPOINT)
    assert L.get_checkpoint(none, key) is None
    started = L.start_stage(none, key)
    began = started.head()["start_time"]
    assert L.start_stage(started, key).count() == 1
    note = json.dumps({"records_processed": 100, "duration_ms": 5000})
    ended = L.set_checkpoint(started, key, "it's done", metadata=note, duration_ms=5000)
    row = ended.head()
    assert (row["status"], row["checkpoint_value"], row["duration_ms"]) == ("completed", "it's done", 5000)
    assert row["start_time"] is not None and began is not None and row["end_time"] is not None
    assert L.get_checkpoint(ended, key) == "it's done"
    assert L.set_checkpoint(ended, ("p", "r2", "load", "end"), "x").count() == 2


def test_refresh_marts_resumes(spark, layers):
    store, _ = layers
    run = monthly.refresh_marts(store)
    stages = rows(store.read("ops.pipeline_checkpoint").orderBy("stage"), "stage", "status")
    assert stages == [("country_sales", "completed"), ("product_performance", "completed")]
    assert rows(store.read("gold.fact_country_sales").orderBy("country"), "country", "unique_customers") == [
        ("France", 0), ("UK", 1)
    ]
    logs = store.read("ops.pipeline_logs")
    assert rows(oplog.logs_by_level(logs)) == [("gold_refresh", run, "INFO", 4)]
    version = store.location("gold.fact_country_sales")
    monthly.refresh_marts(store, run_id=run)  # both stages are done
    assert store.location("gold.fact_country_sales") == version


@pytest.mark.parametrize("count_unknown", [False, True])
def test_partial_refreshes_equal_a_full_run(spark, layers, count_unknown):
    """One setting of the unknown customer holds for full and partial runs of a store."""
    store, _ = layers
    store.count_unknown = count_unknown
    tables = medallion.read_silver(store)
    medallion.build_gold(store, tables, "2011-02-01")
    names = ["gold.fact_sales_monthly", "gold.fact_country_sales", "gold.fact_product_performance"]
    full = {n: sorted(map(str, store.read(n).collect())) for n in names}
    monthly.reset_ledger(store)
    monthly.refresh_months(store, 2011, 1)
    monthly.refresh_marts(store)
    assert {n: sorted(map(str, store.read(n).collect())) for n in names} == full


def test_refresh_marts_records_failure(spark, layers, monkeypatch):
    store, _ = layers
    upsert = store.upsert

    def fail(rows_, name, keys):
        if name == "gold.fact_country_sales":
            raise RuntimeError("disk full")
        upsert(rows_, name, keys)

    monkeypatch.setattr(store, "upsert", fail)
    with pytest.raises(RuntimeError):
        monthly.refresh_marts(store, run_id="r1")
    stages = rows(store.read("ops.pipeline_checkpoint").orderBy("stage"), "stage", "status")
    assert stages == [("country_sales", "failed"), ("product_performance", "completed")]
    errors = store.read("ops.pipeline_logs").where("level = 'ERROR'")
    assert "disk full" in errors.head()["message"]
    monkeypatch.setattr(store, "upsert", upsert)
    monthly.refresh_marts(store, run_id="r1")
    assert {r[0] for r in rows(store.read("ops.pipeline_checkpoint"), "status")} == {"completed"}


def test_logs(spark, store, tmp_path):
    monthly.append_log(store, oplog.log_rows(spark, "p", "r", [("INFO", "a"), ("ERROR", "b")], '{"x": 1}', line=3))
    lines = [
        json.dumps({"timestamp": "2024-01-01T10:00:00", "level": "INFO", "message": "m", "pipeline_name": "p",
                    "run_id": "r2", "metadata": {"k": 1}}),
        "", "{broken", json.dumps({"level": "INFO", "message": "no time"}),
        json.dumps({"timestamp": "2024-01-01 12:00:00", "level": "INFO", "message": "n", "pipeline_name": "p", "run_id": "r2"}),
    ]
    (tmp_path / "fallback.jsonl").write_text("\n".join(lines))
    count, unreadable = monthly.recover_logs(store, str(tmp_path / "fallback.jsonl"))
    assert count == 2 and unreadable.count() == 2
    again, _ = monthly.recover_logs(store, str(tmp_path / "fallback.jsonl"))
    assert again == 0  # a second recovery adds nothing
    logs = store.read("ops.pipeline_logs")
    assert sorted(rows(oplog.logs_by_level(logs))) == [("p", "r", "ERROR", 1), ("p", "r", "INFO", 1), ("p", "r2", "INFO", 2)]
    cover = {r["run_id"]: (r["log_count"], r["first_log"], r["last_log"]) for r in oplog.log_coverage(logs).collect()}
    assert cover["r2"] == (2, dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 12))
    assert rows(logs.where("message = 'm'"), "metadata") == [('{"k":1}',)]
