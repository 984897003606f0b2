import datetime as dt

import frames as T
from frames import D, LINES, bronze, day, rows
from tillworks.operators import reports as R
from tillworks.operators import sales_marts as SM


def test_bronze_summary(spark):
    row = R.bronze_summary(bronze(spark, LINES)).head()
    assert tuple(row) == (11, 9, 5, 4, 2, day(2010, 12, 4), day(2011, 1, 4), D("99.00"))
    empty = R.bronze_summary(bronze(spark, [])).head()
    assert empty["total_records"] == 0 and empty["total_revenue"] is None


def test_ingest_check(spark):
    df = spark.range(95)
    assert rows(R.ingest_count_check(df, 100)) == [(100, 95, 5, True)]
    assert rows(R.ingest_count_check(df, spark.range(101))) == [(101, 95, 6, False)]
    assert rows(R.ingest_count_check(df, 0)) == [(0, 95, -95, True)]


def test_layer_row_counts(spark):
    got = rows(R.layer_row_counts({"silver.b": spark.range(3), "bronze.a": spark.range(0)}))
    assert got == [("bronze.a", 0), ("silver.b", 3)]


def test_bronze_listings(spark):
    lines = bronze(spark, LINES)
    assert rows(R.bronze_revenue_by_country(lines, 2)) == [
        ("UK", 6, D("53.50")), ("France", 3, D("25.50"))
    ]
    assert rows(R.bronze_top_products(lines, 1)) == [("A1", "alpha", 3, 14, D("28.00"))]
    assert rows(R.bronze_daily_volume(lines))[2] == (dt.date(2010, 12, 6), 1, D("-7.50"))
    assert rows(R.bronze_customer_analysis(lines, 1), "customerid", "invoice_count", "total_spent") == [
        ("10.0", 4, D("51.00"))
    ]
    assert rows(R.cancellations_by_month(lines)) == [(2010, 12, 1, D("-7.50"))]


def test_silver_listings(spark):
    _, dates, products, fact = T.silver(spark)
    assert rows(R.silver_daily_rollup(fact, dates, 1)) == [(D("14.00"), 7, 1, dt.date(2011, 1, 4))]
    assert rows(R.silver_top_products(fact, products, 1)) == [("ALPHA", D("30.50"), 15)]
    assert len(rows(R.silver_daily_revenue(fact, dates))) == 5
    assert rows(R.silver_revenue_by_country(fact)) == [("UK", D("33.50"), 2), ("France", D("25.50"), 3)]
    assert tuple(R.silver_metrics(fact, dates, products).head()) == (6, 4, 6, D("59.00"))


def test_gold_listings(spark):
    _, dates, products, fact = T.silver(spark)
    monthly, daily = SM.sales_monthly(fact, dates), SM.sales_daily_enhanced(fact, dates)
    # revenue is not multiplied by the trading days of the month
    assert rows(R.gold_month_name_revenue(monthly, dates)) == [
        (2010, 12, "December", D("45.00"), 16), (2011, 1, "January", D("14.00"), 8)
    ]
    assert rows(R.gold_weekday_analysis(daily, dates), "day_name", "days") == [
        ("Sunday", 1), ("Monday", 1), ("Tuesday", 1), ("Friday", 1), ("Saturday", 1)
    ]
    assert [r[:2] for r in rows(R.gold_monthly_trend(monthly))] == [(2011, 1), (2010, 12)]
    assert [r[:2] for r in rows(R.gold_latest_months(monthly, 1))] == [(2011, 1)]
    assert rows(R.gold_top10_products(SM.product_performance(fact, products, dates), 1), "stock_code") == [("A1",)]
    ranking = R.gold_country_ranking(SM.country_sales(fact, dates))
    assert rows(ranking, "country") == [("UK",), ("France",)]
    assert rows(R.gold_country_ranking(SM.country_sales(fact, dates), 1), "country") == [("UK",)]
    trend = R.gold_daily_trend_30(SM.day_over_day(daily), 2)
    assert rows(trend, "date") == [(dt.date(2011, 1, 4),), (dt.date(2011, 1, 3),)]
