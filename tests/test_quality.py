import datetime as dt

import pytest

import frames as T
from frames import D, LINES, bronze, day, rows
from tillworks import schemas
from tillworks.operators import quality as Q
from tillworks.plans import medallion


def outcome(df):
    return {r["check_name"]: (r["failing_rows"], r["passed"]) for r in df.collect()}


def test_row_checks_share_a_scan(spark):
    df = spark.createDataFrame(
        [(1, "a", 5.0), (2, None, -1.0), (None, "zz", 20000.0)], "id int, s string, p double"
    )
    got = outcome(Q.table_checks(df, "t", [
        Q.not_null("id"), Q.not_null("p"), Q.accepted_values("s", ["a"]), Q.in_range("p", 0, 10000),
        Q.in_range("p", low=0), Q.max_length("s", 1), Q.has_rows(), Q.positive_total("p"),
        Q.date_bounds("p"), Q.distinct_present("s"),
    ]))
    assert got["t.not_null:id"] == (1, False) and got["t.not_null:p"] == (0, True)
    assert got["t.accepted_values:s"] == (1, False)  # NULL is no value
    assert got["t.max_length:s"] == (1, False)
    assert got["t.has_rows"] == got["t.positive_total:p"] == got["t.date_bounds:p"] == (0, True)
    assert got["t.distinct_present:s"] == (0, True)
    assert len(got) == 9  # both ranges of p share a name


def test_checks_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "id int, p double")
    got = outcome(Q.table_checks(empty, "t", [
        Q.not_null("id"), Q.has_rows(), Q.positive_total("p"), Q.date_bounds("p"), Q.distinct_present("id"),
    ]))
    assert got == {
        "t.not_null:id": (0, True), "t.has_rows": (1, False), "t.positive_total:p": (1, False),
        "t.date_bounds:p": (1, False), "t.distinct_present:id": (1, False),
    }
    assert outcome(Q.unique(empty, "t", ["id"])) == {"t.unique:id": (0, True)}
    assert outcome(Q.relationships(empty, "t", "id", empty)) == {"t.relationships:id": (0, True)}


def test_unique_key_shares_the_scan(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "x"), (None, None)], "k int, s string")
    got = outcome(Q.table_checks(df, "t", [Q.not_null("s"), Q.not_null("k")], unique_key="k"))
    assert got == {"t.not_null:s": (2, False), "t.not_null:k": (2, False), "t.unique:k": (1, False)}
    none = outcome(Q.table_checks(df.where("false"), "t", [Q.not_null("s")], unique_key="k"))
    assert none == {"t.not_null:s": (0, True), "t.unique:k": (0, True)}
    with pytest.raises(ValueError):
        Q.table_checks(df, "t", [Q.has_rows()], unique_key="k")


def test_unique_and_relationships(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "x"), (None, "x")], "k int, s string")
    assert outcome(Q.unique(df, "t", ["k"])) == {"t.unique:k": (2, False)}
    assert outcome(Q.unique(df, "t", ["k", "s"])) == {"t.unique:k,s": (1, False)}
    parent = spark.createDataFrame([(1,), (1,), (3,)], "pk int")
    assert outcome(Q.relationships(df, "t", "k", parent, "pk")) == {"t.relationships:k": (2, False)}


def test_columns_match(spark):
    df = spark.createDataFrame([], schemas.DIM_DATE)
    assert outcome(Q.columns_match(df, "d", schemas.DIM_DATE.names)) == {"d.columns_match": (0, True)}
    assert outcome(Q.columns_match(df, "d", schemas.DIM_DATE.names[::-1])) == {"d.columns_match": (1, False)}


def test_reconcile(spark):
    rows_ok = [r for r in LINES if r[7] is not None and r[1] != "NODESC"]
    lines, _, _, fact = T.silver(spark, rows_ok)
    row = Q.reconcile_layers(lines, fact).head()
    assert row["revenue_matches"] and row["quantity_matches"]
    assert row["bronze_revenue"] == D("59.00") and row["bronze_quantity"] == 24
    # a line without a country is in bronze only
    row = Q.reconcile_layers(bronze(spark, LINES), fact).head()
    assert not row["revenue_matches"] and not row["quantity_matches"]


def test_freshness(spark):
    df = spark.createDataFrame([(day(2024, 1, 1, 0),)], "ts timestamp_ntz")
    states = [
        rows(Q.freshness(df, "ts", now), "age_hours", "status")[0]
        for now in ["2024-01-02 00:30:00", "2024-01-02 01:30:00", "2024-01-03 00:30:00", "2024-01-03 01:30:00"]
    ]
    assert states == [(24, "pass"), (25, "warn"), (48, "warn"), (49, "error")]
    assert rows(Q.freshness(df.where("false"), "ts"), "status") == [("error",)]


def test_suite_on_a_clean_run(spark):
    good = [r for r in LINES if r[6] != "junk" and r[1] != "NODESC" and r[7] is not None]
    lines, dates, products, fact = T.silver(spark, good)
    tables = {"dim_date": dates, "dim_product": products, "fact_sales_daily": fact}
    tables |= {n: m(tables) for n, m in medallion.gold_models(dt.date(2011, 1, 5)).items()}
    results = Q.suite(tables | {"raw_transactions": lines})
    got = outcome(results)
    assert all(ok for _, ok in got.values()), got
    declared = [n for n in got if n.split(".")[1].split(":")[0] in
                ("not_null", "unique", "relationships", "accepted_values")]
    # the declared checks (the two on the dropped serial id excepted) and the fact's key
    assert len(declared) == 47 + 1
    total = Q.summarize(results).head()
    assert (total["checks"], total["failed"], total["ok"]) == (len(got), 0, True)


def test_suite_finds_junk_customers(spark):
    lines, dates, products, fact = T.silver(spark)
    tables = {"dim_date": dates, "dim_product": products, "fact_sales_daily": fact}
    tables |= {n: m(tables) for n, m in medallion.gold_models("2011-01-05").items()}
    results = Q.suite(tables | {"raw_transactions": lines})
    failed = {n: v for n, v in outcome(results).items() if not v[1]}
    assert failed == {"raw_transactions.customer_parses:customerid": (1, False)}
    assert not Q.summarize(results).head()["ok"]
