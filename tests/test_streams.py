import os

import pytest

from frames import D, rows
from tillworks import schemas
from tillworks.operators import sales_marts as SM
from tillworks.operators import silver as S
from tillworks.sources import transactions as X
from tillworks.sources.layers import write_bronze
from tillworks.streaming import daily, landing

HEAD = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
FIRST = HEAD + """1,B1,beta,6,01/12/2010 8:26,2.50,10,UK
1,B1,beta,1,01/12/2010 8:26,2.50,10,UK
2,B1,beta,2,01/12/2010 9:00,2.50,20.0,UK
C3,B1,beta,-6,02/12/2010 9:00,2.50,10,UK
,B1,beta,1,02/12/2010 9:00,2.50,10,UK
"""
SECOND = HEAD + """4,A1,alpha,1,05/01/2011 9:00,4.00,,France
5,B1,beta,3,30/12/2010 9:00,2.50,10,UK
"""
THIRD = HEAD + "6,B1,beta,1,01/03/2011 9:00,2.50,10,UK\n"


def land(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_bronze_takes_each_file_once(spark, store, tmp_path):
    inbox, mark = tmp_path / "in", str(tmp_path / "mark")

    def drain():
        landing.stream_bronze(landing.landing_lines(spark, str(inbox)), store, mark)
        return store.read(landing.BRONZE).count()

    land(inbox, "a.csv", FIRST)
    assert drain() == 4
    assert drain() == 4
    land(inbox, "b.csv", SECOND)
    assert drain() == 6
    batch = X.clean_strict(X.read_transactions(spark, str(inbox))).drop("source_file")
    streamed = store.read(landing.BRONZE).select(*batch.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def full_run(spark, *folders, count_unknown=False):
    """(monthly rows, daily rows) of a batch run over all files."""
    lines = X.clean_strict(X.read_transactions(spark, [str(f) for f in folders]))
    dates, products = S.dim_date(lines), S.dim_product(lines)
    fact = S.fact_sales_daily(lines, dates, products)
    monthly_rows = sorted(map(str, rows(SM.sales_monthly(fact, dates, count_unknown))))
    return monthly_rows, sorted(map(str, rows(daily.daily_sales(lines).drop("invoice_month"))))


def found(store):
    months = store.read("gold.fact_sales_monthly") if store.exists("gold.fact_sales_monthly") else None
    days = store.read(daily.DAILY).drop("invoice_month") if store.exists(daily.DAILY) else None
    return [sorted(map(str, rows(df))) if df is not None else None for df in (months, days)]


@pytest.mark.parametrize("job", ["months", "days"])
def test_two_landings_and_a_renewed_checkpoint_share_a_root(spark, store, tmp_path, job):
    one, two = tmp_path / "one", tmp_path / "two"
    run = landing.refresh_touched_months if job == "months" else (lambda s, lines, mark: daily.stream_daily_sales(X.clean_strict(lines), s, mark))

    def drain(folder, mark):
        run(store, landing.landing_lines(spark, str(folder)), str(tmp_path / mark))

    land(one, "a.csv", FIRST)
    land(two, "b.csv", SECOND)
    drain(one, "mark-1")
    drain(two, "mark-2")
    months, days = full_run(spark, one, two)
    at = 0 if job == "months" else 1
    assert found(store)[at] == (months, days)[at]
    land(one, "c.csv", THIRD)
    drain(one, "mark-3")  # a new checkpoint sees a.csv again
    assert store.read(landing.BRONZE).count() == 7
    assert found(store)[at] == full_run(spark, one, two)[at]


def bronze_files(store, batch=None):
    from pathlib import Path

    found = Path(store.location(landing.BRONZE)).glob(f"ingest_batch={batch or '*'}/**/*.parquet")
    return sorted(found)


def test_a_batch_opens_no_earlier_file_of_bronze(spark, store, tmp_path):
    """Earlier batches are made unreadable: the next one, also of a renewed checkpoint, does not notice."""
    inbox = tmp_path / "in"

    def drain(mark):
        landing.stream_bronze(landing.landing_lines(spark, str(inbox)), store, str(tmp_path / mark))

    land(inbox, "a.csv", FIRST)
    drain("mark-1")
    land(inbox, "b.csv", SECOND)
    drain("mark-1")
    old = bronze_files(store)
    assert old
    for f in old:
        f.write_bytes(b"no parquet")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    land(inbox, "c.csv", THIRD)
    drain("mark-2")  # sees all three files, takes the third
    new = [str(f) for f in bronze_files(store) if f not in old]
    assert spark.read.parquet(*new).select("invoiceno").collect() == [("6",)]
    names = sorted(r[0].rsplit("/", 1)[1] for r in landing.landed_files(store).select("source_file").collect())
    assert names == ["a.csv", "b.csv", "c.csv"]


def test_the_ledger_catches_up_with_bronze(spark, store, tmp_path):
    """A crash before the ledger was written, bronze of older date, a full refresh, lines without a file name."""
    inbox = tmp_path / "in"
    land(inbox, "a.csv", FIRST)
    lines = X.clean_strict(X.read_transactions(spark, str(inbox)))
    write_bronze(store, X.bronze_rows(lines, "by-hand").select(*schemas.BRONZE_TABLE.names))
    unnamed = X.bronze_rows(lines.drop("source_file"), "2011").select(*schemas.BRONZE_TABLE.names)
    write_bronze(store, unnamed)
    assert not store.exists(landing.LANDED)
    assert landing.take_batch(store, lines, "b-0").count() == 0  # by-hand brought the file
    assert store.read(landing.BRONZE).count() == 8
    assert landing._batches(store, f"{store.location(landing.LANDED)}/bronze_version=1") == {"by-hand", "2011"}
    write_bronze(store, unnamed, "overwrite")  # a full refresh without that file
    assert landing.take_batch(store, lines, "b-1").count() == 4
    assert landing.take_batch(store, lines, "b-1").count() == 4  # a replay
    assert landing.take_batch(store, lines, "b-2").count() == 0
    assert store.read(landing.BRONZE).count() == 8


@pytest.mark.parametrize("order", [("a", "b", "c"), ("c", "b", "a"), ("b", "c", "a")])
def test_days_do_not_depend_on_batches(spark, store, tmp_path, order):
    """Files in any order, one per trigger, give the days of a batch run."""
    inbox, texts = tmp_path / "in", {"a": FIRST, "b": SECOND, "c": THIRD}
    for age, name in enumerate(order):
        land(inbox, f"{name}.csv", texts[name])
        os.utime(inbox / f"{name}.csv", (1_600_000_000 + age, 1_600_000_000 + age))
    lines = landing.landing_lines(spark, str(inbox), bytes_per_trigger=1)
    daily.stream_daily_sales(X.clean_strict(lines), store, str(tmp_path / "mark"))
    assert store.read(landing.BRONZE).select("ingest_batch").distinct().count() == 3
    assert found(store)[1] == full_run(spark, inbox)[1]


def test_arrivals(spark, tmp_path):
    land(tmp_path / "in", "a.csv", FIRST)
    land(tmp_path / "in", "b.csv", SECOND)
    got = {r["file_name"]: r for r in landing.arrivals(spark, str(tmp_path / "in")).collect()}
    assert {n: r["row_count"] for n, r in got.items()} == {"a.csv": 5, "b.csv": 2}
    assert got["a.csv"]["file_size"] == len(FIRST) and got["a.csv"]["modified_at"] is not None


def test_touched_months_equal_a_full_run(spark, store, tmp_path):
    inbox, mark = tmp_path / "in", str(tmp_path / "mark")

    def drain():
        landing.refresh_touched_months(store, landing.landing_lines(spark, str(inbox)), mark)

    land(inbox, "a.csv", FIRST)
    drain()
    assert rows(store.read("silver.dim_product"), "product_id", "stock_code") == [(1, "B1")]
    land(inbox, "b.csv", SECOND)
    drain()
    drain()  # nothing new
    lines = X.clean_strict(X.read_transactions(spark, str(inbox)))
    dates, products = S.dim_date(lines), S.dim_product(lines)
    full = S.fact_sales_daily(lines, dates, products)
    want = sorted(map(str, rows(SM.sales_monthly(full, dates))))
    assert sorted(map(str, rows(store.read("gold.fact_sales_monthly")))) == want
    # the first batch's id stays although A1 sorts before B1
    ids = sorted(rows(store.read("silver.dim_product"), "product_id", "stock_code"))
    assert ids == [(1, "B1"), (2, "A1")]
    done = sorted(rows(store.read("ops.processed_months"), "month_key", "status"))
    assert done == [("2010-12", "completed"), ("2011-01", "completed")]


def test_a_replayed_batch_replaces_itself(spark, store, tmp_path):
    land(tmp_path / "in", "a.csv", FIRST)
    lines = X.clean_strict(X.read_transactions(spark, str(tmp_path / "in")))
    for _ in range(2):
        landing.refresh_batch(store, lines, "batch-0")
    assert store.read("bronze.raw_transactions").count() == 4
    assert rows(store.read("gold.fact_sales_monthly"), "total_revenue") == [(D("22.50"),)]


def test_daily_sales_counts_invoices_exactly(spark, store, tmp_path):
    inbox, mark = tmp_path / "in", str(tmp_path / "mark")

    def drain():
        lines = X.clean_strict(landing.landing_lines(spark, str(inbox)))
        daily.stream_daily_sales(lines, store, mark)
        out = store.read(daily.DAILY).drop("invoice_month").orderBy("date", "stock_code")
        return [(str(r[0]), *r[1:]) for r in rows(out)]

    first = [("2010-12-01", "B1", "UK", 20, 2, 9, D("22.50"))]
    land(inbox, "a.csv", FIRST)
    assert drain() == first
    land(inbox, "b.csv", SECOND)
    more = [("2010-12-30", "B1", "UK", 10, 1, 3, D("7.50")), ("2011-01-05", "A1", "France", -1, 1, 1, D("4.00"))]
    assert drain() == first + more


def test_days_do_not_depend_on_the_time_zone(spark, store, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        land(tmp_path / "in", "a.csv", FIRST.replace("01/12/2010 9:00", "01/12/2010 23:59"))
        land(tmp_path / "in", "b.csv", SECOND)
        lines = X.clean_strict(landing.landing_lines(spark, str(tmp_path / "in")))
        daily.stream_daily_sales(lines, store, str(tmp_path / "mark"))
        got = rows(store.read(daily.DAILY).orderBy("date"), "date", "total_quantity")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(str(d), q) for d, q in got] == [("2010-12-01", 9), ("2010-12-30", 3), ("2011-01-05", 1)]
