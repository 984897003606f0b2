import datetime as dt

import pytest
from pyspark.sql import functions as F

import frames as T
from frames import D, LINES, bronze, rows
from tillworks import schemas
from tillworks.operators import ranking
from tillworks.operators import silver as S


def test_dim_date(spark):
    dates = S.dim_date(bronze(spark, LINES))
    assert dates.columns == schemas.DIM_DATE.names
    found = {r["date_id"]: r for r in dates.collect()}
    assert sorted(found) == [20101204, 20101205, 20101206, 20101231, 20110103, 20110104]
    sat, sun, mon = (found[i] for i in (20101204, 20101205, 20101206))
    assert (sat["day_name"], sat["day_of_week"], sat["is_weekend"]) == ("Saturday", 6, True)
    assert (sun["day_name"], sun["day_of_week"], sun["is_weekend"]) == ("Sunday", 0, True)
    assert (mon["day_name"], mon["day_of_week"], mon["is_weekend"]) == ("Monday", 1, False)
    assert (mon["day"], mon["month"], mon["month_name"], mon["quarter"], mon["year"]) == (6, 12, "December", 4, 2010)
    assert mon["date"] == dt.date(2010, 12, 6) and mon["is_holiday"] is False


def test_dim_date_padded(spark):
    names = rows(S.dim_date(bronze(spark, LINES[:1]), pg_padded=True), "day_name", "month_name")
    assert names == [("Saturday ", "December ")]


def test_dim_product(spark):
    products = S.dim_product(bronze(spark, LINES))
    assert products.columns == schemas.DIM_PRODUCT.names
    # NODESC has no description; 'ALPHA' < 'alpha' in binary order
    assert sorted(rows(products)) == [
        (1, "A1", "ALPHA", "General"), (2, "B2", "beta", "General"),
        (3, "M", "manual", "Manual"), (4, "POST", "postage", "Postage"),
    ]


def test_extended_dimension_keeps_ids(spark):
    first = S.dim_product(bronze(spark, [LINES[0], LINES[6]]))
    added = S.extend_dim_product(first, bronze(spark, LINES))
    assert sorted(rows(first, "product_id", "stock_code")) == [(1, "B2"), (2, "POST")]
    assert sorted(rows(added, "product_id", "stock_code")) == [(3, "A1"), (4, "M")]
    assert S.extend_dim_product(first.unionByName(added), bronze(spark, LINES)).count() == 0


def test_fact(spark):
    _, _, _, fact = T.silver(spark)
    assert fact.columns == schemas.FACT_SALES_DAILY.names
    assert [f.dataType for f in fact.schema] == [f.dataType for f in schemas.FACT_SALES_DAILY]
    found = {tuple(r)[:3]: tuple(r)[3:] for r in fact.collect()}
    assert found == {
        # two customers in a group: the larger id; two lines of invoice 2 count once
        (20101204, 1, "UK"): (20, 2, 8, D("16.50"), D("2.166667"), 2010, 12),
        (20101204, 2, "UK"): (10, 1, 2, D("3.00"), D("1.500000"), 2010, 12),
        (20101205, 2, "France"): (-1, 1, 5, D("7.50"), D("1.500000"), 2010, 12),
        (20101231, 4, "France"): (-1, 1, 1, D("18.00"), D("18.000000"), 2010, 12),
        (20110103, 3, "France"): (10, 1, 1, D("0.00"), D("0.000000"), 2011, 1),
        (20110104, 1, "UK"): (-1, 1, 7, D("14.00"), D("2.000000"), 2011, 1),
    }


def test_fact_only_has_dates_of_the_dimension(spark):
    lines, dates, products, _ = T.silver(spark)
    some = dates.where("year = 2011")
    assert set(rows(S.fact_sales_daily(lines, some, products), "date_id")) == {(20110103,), (20110104,)}


def test_positions_are_consecutive_over_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7919 % 5000).alias("k"))
    out = ranking.with_position(df, ["k"], "n", start=10)
    assert out.where(F.col("n") != F.col("k") + 10).count() == 0
    assert ranking.with_position(df.where("false"), ["k"], "n").count() == 0


def test_group_positions_equal_row_number(spark):
    from pyspark.sql import Window

    # one group holds a third of the rows
    df = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        (F.col("id") % 11).alias("v"), "id",
    )
    w = Window.partitionBy("g").orderBy(F.desc("v"), "id")
    want = df.withColumn("n", F.row_number().over(w).cast("bigint"))
    got = ranking.with_group_position(df, ["g"], [F.desc("v"), F.asc("id")], "n")
    assert got.exceptAll(want).count() == 0 and got.count() == 3000


@pytest.mark.parametrize("bound,most,ranges", [(3000, 5000, 200), (3000, 40, 200), (3000, 200, 7), (3000, 0, 3)])
def test_group_ranks_equal_row_number(spark, monkeypatch, bound, most, ranges):
    from pyspark.sql import Window

    monkeypatch.setattr(ranking, "RANGES", ranges)
    # one group holds a third of the rows, many of them equal in value; some values are NULL
    df = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        F.when(F.col("id") % 17 > 0, (F.col("id") % 11).cast("decimal(18,2)")).alias("v"),
        F.when(F.col("id") % 5 == 0, F.lit(3)).otherwise(F.col("id") * 7919 % 400).alias("u"), "id",
    )
    want = df
    for name, value in (("n", "v"), ("m", "u")):
        w = Window.partitionBy("g").orderBy(F.desc(value), "id")
        want = want.withColumn(name, F.row_number().over(w).cast("bigint"))
    want = want.withColumn("s", F.sum("u").over(Window.partitionBy("g")))
    got = ranking.group_ranks(df, "g", "id", {"n": "v", "m": "u"}, ("s", "u"), bound, most).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == 3000


def test_small_groups_take_one_shuffle_and_a_sort_per_rank(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("g"), "id", (F.col("id") % 5).alias("v"))
    got = ranking.group_ranks(df, "g", "id", {"n": "v", "m": "id"}, ("s", "v"), 100)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("Sort [") == 2 and "ExistingRDD" not in text


