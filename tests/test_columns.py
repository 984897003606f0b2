import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import D, rows
from tillworks.functions import columns as C


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()[0]


@pytest.mark.parametrize(
    "code,label",
    [
        ("DISC1", "Discount"), ("M", "Manual"), ("MEDIUM-1", "Manual"), ("POST", "Postage"),
        ("C2", "Carriage"), ("C3", "General"), ("BANK CHARGES", "Bank Charges"),
        ("TEST001", "Test"), ("PADS", "Pads"), ("85123A", "General"), ("post", "General"),
        ("xDISC", "General"),
    ],
)
def test_product_category(spark, code, label):
    assert one(spark, C.product_category(F.lit(code))) == label


@pytest.mark.parametrize(
    "text,cut,rounded",
    [
        ("17850.0", 17850, 17850), ("17850.6", 17850, 17851), ("17850", 17850, 17850),
        ("", -1, -1), (None, -1, -1), ("abc", -1, -1), ("99999999999", 99999999999, 99999999999),
        ("3000000000.0", 3000000000, 3000000000), ("99999999999999999999", -1, -1),
    ],
)
def test_parse_customer_id(spark, text, cut, rounded):
    c = F.lit(text).cast("string")
    assert one(spark, C.parse_customer_id(c)) == cut
    assert one(spark, C.parse_customer_id(c, numeric=True)) == rounded


def test_junk_customer(spark):
    df = spark.createDataFrame([("1.0",), ("x",), ("",), (None,)], "c string")
    assert rows(df.select(C.is_junk_customer("c"))) == [(False,), (True,), (False,), (False,)]


@pytest.mark.parametrize(
    "value,label",
    [
        ("10000", "VIP"), ("9999.99", "High Value"), ("5000", "High Value"), ("4999.99", "Medium Value"),
        ("1000", "Medium Value"), ("999.99", "Low Value"), ("100", "Low Value"), ("99.99", "Very Low Value"),
    ],
)
def test_segment(spark, value, label):
    assert one(spark, C.customer_segment(F.lit(D(value)))) == label


@pytest.mark.parametrize(
    "days,customer,product",
    [
        (30, "Active (0-30 days)", "Recent"), (31, "Recent (31-90 days)", "Moderate"),
        (90, "Recent (31-90 days)", "Moderate"), (91, "At Risk (91-180 days)", "Old"),
        (180, "At Risk (91-180 days)", "Old"), (181, "Churned (180+ days)", "Old"),
        (-5, "Active (0-30 days)", "Recent"),
    ],
)
def test_recency(spark, days, customer, product):
    assert one(spark, C.recency_bucket(F.lit(days))) == customer
    assert one(spark, C.product_recency(F.lit(days))) == product


@pytest.mark.parametrize(
    "revenue,label",
    [("1000", "High Spender"), ("500", "Medium Spender"), ("100", "Regular Spender"), ("99.99", "Occasional Spender")],
)
def test_spending(spark, revenue, label):
    assert one(spark, C.spending_level(F.lit(D(revenue)))) == label


@pytest.mark.parametrize(
    "rank,share,times,label",
    [
        (3, 1, 1, "Top 3 Product"), (4, 90, 50, "Top 10 Product"), (11, 25, 1, "Major Product (25%+ spend)"),
        (11, 24, 10, "Frequently Bought"), (11, 24, 9, "Occasional Purchase"),
    ],
)
def test_affinity(spark, rank, share, times, label):
    assert one(spark, C.affinity_level(F.lit(rank), F.lit(share), F.lit(times))) == label


def test_rounding_is_half_away_from_zero(spark):
    assert one(spark, C.ratio2(F.lit(D("1.005")), F.lit(1))) == D("1.01")
    assert one(spark, C.ratio2(F.lit(-201), F.lit(200))) == D("-1.01")
    assert one(spark, C.ratio2(F.lit(1), F.lit(0))) is None
    assert one(spark, C.safe_avg(F.lit(5), F.lit(0))) == 0
    assert one(spark, C.safe_avg(F.lit(5), F.lit(None).cast("int"))) == 0


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(D("0.10"),)] * 10 + [(D("-0.01"),), (None,)], "x decimal(10,2)")
    assert df.agg(C.money_sum("x")).head()[0] == D("0.99")
    assert df.where("false").agg(C.money_sum("x")).head()[0] is None


def test_dates(spark):
    d = F.lit("2011-01-02").cast("date")
    assert one(spark, C.date_id(d)) == 20110102
    assert one(spark, C.day_of_week(d)) == 0  # a Sunday
    assert one(spark, C.month_key(F.lit(2011), F.lit(2))) == "2011-02"
    assert one(spark, C.as_of_date("2011-01-02")) == dt.date(2011, 1, 2)
    assert one(spark, C.as_of_date(None)) is not None
