from pyspark.sql import Window
from pyspark.sql import functions as F
import datetime as dt

import frames as T
from frames import D, keyed, rows
from tillworks.operators import customer_marts as CM
from tillworks.operators import sales_marts as SM

d = dt.date
DAYS = [d(2010, 12, 30), d(2010, 12, 31), d(2011, 1, 3), d(2011, 2, 1)]
ROWS = [
    (DAYS[0], 1, "UK", 10, 2, 4, "100.00"),
    (DAYS[0], 2, "UK", -1, 1, 1, "50.00"),
    (DAYS[1], 1, "UK", 10, 1, 2, "50.00"),
    (DAYS[1], 2, "France", 10, 1, 2, "75.25"),
    (DAYS[2], 2, "France", 20, 3, 9, "0.00"),
    (DAYS[3], 3, "UK", 20, 1, 1, "10.01"),
    (DAYS[3], 1, "UK", 10, 1, 1, "149.99"),
]


def parts(spark):
    return T.fact(spark, ROWS), T.dates_of(spark, DAYS), T.products(spark, 3)


def test_monthly(spark):
    f, dates, _ = parts(spark)
    got = {(r["year"], r["month"]): r for r in SM.sales_monthly(f, dates).collect()}
    assert set(got) == {(2010, 12), (2011, 1), (2011, 2)}
    dec = got[2010, 12]
    assert (dec["total_revenue"], dec["total_quantity"], dec["total_transactions"]) == (D("275.25"), 9, 5)
    assert (dec["total_products"], dec["total_countries"], dec["unique_customers"]) == (2, 2, 1)
    assert (dec["avg_revenue_per_transaction"], dec["avg_quantity_per_transaction"]) == (D("55.05"), D("1.80"))
    assert (dec["cancelled_transactions"], dec["cancelled_revenue"]) == (0, D("0.00"))
    raw = keyed(SM.sales_monthly(f, dates, count_unknown=True), "month", "unique_customers")
    assert raw[12] == (2,)


def test_zero_transactions_average_to_zero(spark):
    f = T.fact(spark, [(DAYS[0], 1, "UK", 1, 0, 0, "5.00")])
    row = SM.sales_monthly(f, T.dates_of(spark, DAYS)).head()
    assert row["avg_revenue_per_transaction"] == 0 and row["avg_quantity_per_transaction"] == 0


def test_product_performance(spark):
    f, dates, products = parts(spark)
    got = {r["product_id"]: r for r in SM.product_performance(f, products, dates).collect()}
    one = got[1]
    assert (one["total_revenue"], one["total_days_sold"], one["total_countries"]) == (D("299.99"), 3, 1)
    assert (one["avg_revenue_per_day"], one["avg_quantity_per_day"]) == (D("100.00"), D("2.33"))
    assert (one["first_sale_date"], one["last_sale_date"]) == (DAYS[0], DAYS[3])
    assert one["stock_code"] == "P1"


def test_country_sales_and_top_product(spark):
    f, dates, _ = parts(spark)
    got = {r["country"]: r for r in SM.country_sales(f, dates).collect()}
    assert (got["UK"]["top_product_id"], got["UK"]["top_product_revenue"]) == (1, D("299.99"))
    assert (got["UK"]["unique_customers"], got["UK"]["total_days_active"]) == (2, 3)
    raw = keyed(SM.country_sales(f, dates, count_unknown=True), "country", "unique_customers")
    assert raw == {"UK": (3,), "France": (2,)}


def test_top_product_tie_goes_to_the_smaller_id(spark):
    f = T.fact(spark, [(DAYS[0], p, "UK", 1, 1, 1, "5.00") for p in (3, 2, 7)])
    assert rows(SM.top_product_per_country(f)) == [("UK", 2, D("5.00"))]


def test_daily_and_trend(spark):
    f, dates, _ = parts(spark)
    daily = SM.sales_daily_enhanced(f, dates)
    got = {r["date"]: r for r in SM.day_over_day(daily).collect()}
    assert got[DAYS[2]]["week_of_year"] == 1 and got[DAYS[0]]["week_of_year"] == 52
    first, second, third, fourth = (got[x] for x in DAYS)
    assert first["revenue_vs_previous_day"] is None and first["quantity_vs_previous_day_pct"] is None
    assert second["revenue_vs_previous_day"] == D("-24.75")
    assert second["revenue_vs_previous_day_pct"] == D("-16.50")
    # over the gap to the previous trading day
    assert third["transactions_vs_previous_day"] == 1 and third["transactions_vs_previous_day_pct"] == D("50.00")
    # the day before had no revenue
    assert fourth["revenue_vs_previous_day"] == D("160.00") and fourth["revenue_vs_previous_day_pct"] is None


def test_sales_marts(spark):
    f, dates, products = parts(spark)
    summary = rows(SM.monthly_sales_summary(f, dates), "year", "month", "month_name", "total_revenue")
    assert summary == [
        (2010, 12, "December", D("275.25")), (2011, 1, "January", D("0.00")), (2011, 2, "February", D("160.00")),
    ]
    top = rows(SM.top_products_by_revenue(f, products, 2), "stock_code", "total_revenue", "avg_revenue_per_unit")
    assert top == [("P1", D("299.99"), D("42.86")), ("P2", D("125.25"), D("10.44"))]
    perf = rows(SM.country_performance(f, dates), "country", "active_days", "avg_daily_revenue")
    assert perf == [("UK", 3, D("120.00")), ("France", 2, D("37.63"))]


def test_units_of_zero_have_no_average(spark):
    f = T.fact(spark, [(DAYS[0], 1, "UK", 1, 1, 0, "5.00")])
    assert rows(SM.top_products_by_revenue(f, T.products(spark, 1)), "avg_revenue_per_unit") == [(None,)]


def test_lifetime_value(spark):
    f, dates, products = parts(spark)
    got = {r["customer_id"]: r for r in CM.customer_lifetime_value(f, dates, products, "2011-03-03").collect()}
    assert set(got) == {10, 20}
    ten = got[10]
    assert ten["country"] == "UK" and ten["customer_segment"] == "Low Value"
    assert (ten["total_purchase_days"], ten["total_product_purchases"], ten["total_orders"]) == (3, 4, 5)
    assert ten["total_lifetime_value"] == D("375.24") and ten["avg_daily_revenue"] == D("93.81")
    assert ten["max_daily_revenue"] == D("149.99") and ten["avg_order_value"] == D("75.048")
    assert (ten["customer_lifespan_days"], ten["unique_products_purchased"]) == (33, 2)
    assert round(float(ten["purchase_frequency"]), 6) == round(3 / 33, 6)
    assert ten["recency_category"] == "Active (0-30 days)"
    late = keyed(CM.customer_lifetime_value(f, dates, products, "2011-03-04"), "customer_id", "recency_category")
    assert late[10] == ("Recent (31-90 days)",)
    assert rows(CM.customer_segment_counts(CM.customer_lifetime_value(f, dates, products)).orderBy("customer_segment")) == [
        ("Low Value", 1), ("Very Low Value", 1)
    ]


def test_single_day_customer_has_no_frequency(spark):
    f = T.fact(spark, [(DAYS[0], 1, "UK", 1, 1, 1, "5.00")])
    row = CM.customer_lifetime_value(f, T.dates_of(spark, DAYS), T.products(spark, 1), "2011-01-01").head()
    assert row["customer_lifespan_days"] == 0 and row["purchase_frequency"] == 0


def test_primary_country_tie_by_name(spark):
    f = T.fact(spark, [(DAYS[0], 1, c, 1, 1, 1, "5.00") for c in ("UK", "France")])
    assert rows(CM.primary_country(f)) == [(1, "France")]


def test_monthly_activity(spark):
    f, dates, _ = parts(spark)
    got = {
        (r["customer_id"], r["country"], r["year"], r["month"]): r
        for r in CM.customer_monthly_activity(f, dates).collect()
    }
    assert set(got) == {(10, "France", 2010, 12), (10, "UK", 2010, 12), (10, "UK", 2011, 2),
                        (20, "France", 2011, 1), (20, "UK", 2011, 2)}
    # two countries in one month: by name
    first, second, third = got[10, "France", 2010, 12], got[10, "UK", 2010, 12], got[10, "UK", 2011, 2]
    assert (first["is_first_month"], first["prev_month_revenue"], first["revenue_growth_pct"]) == (True, None, None)
    assert (second["customer_tenure_months"], second["prev_month_revenue"]) == (2, D("75.25"))
    assert round(float(second["revenue_growth_pct"]), 4) == round((150 - 75.25) / 75.25 * 100, 4)
    assert (third["spending_level"], third["customer_tenure_months"]) == ("Regular Spender", 3)
    # nothing to grow from
    assert got[20, "UK", 2011, 2]["revenue_growth_pct"] is None


def test_affinity(spark):
    f, dates, products = parts(spark)
    aff = CM.customer_product_affinity(f, products, dates, "2011-02-01")
    got = {(r["customer_id"], r["product_id"]): r for r in aff.collect()}
    one, two = got[10, 1], got[10, 2]
    assert (one["times_purchased"], one["days_buying_this_product"]) == (3, 33)
    assert (one["product_rank_by_revenue"], two["product_rank_by_revenue"]) == (1, 2)
    assert round(float(one["pct_of_customer_spend"]), 4) == round(29999 / 375.24, 4)
    assert round(float(one["purchase_frequency"]), 6) == round(3 / 34, 6)
    assert two["purchase_frequency"] == 1 and two["recency_category"] == "Moderate"
    assert one["recency_category"] == "Recent" and one["affinity_level"] == "Top 3 Product"
    assert rows(CM.affinity_level_counts(aff)) == [("Top 3 Product", 4)]


def test_affinity_without_spend(spark):
    f = T.fact(spark, [(DAYS[0], 1, "UK", 1, 1, 1, "0.00")])
    row = CM.customer_product_affinity(f, T.products(spark, 1), T.dates_of(spark, DAYS), "2011-01-01").head()
    assert row["pct_of_customer_spend"] is None and row["affinity_level"] == "Top 3 Product"


def test_affinity_of_a_hot_customer(spark):
    """One customer holds a third of the rows; ranks equal windows over the customer."""
    day = DAYS[0]
    data = [(day, p, "UK", 1 if p % 3 == 0 else p % 7 + 2, 1, 1 + p % 4, f"{p % 13}.50") for p in range(1, 301)]
    data += [(DAYS[1], p, "UK", 1, 1, 1, "1.00") for p in range(3, 100, 9)]
    f, dates, products = T.fact(spark, data), T.dates_of(spark, DAYS), T.products(spark, 300)
    got = CM.customer_product_affinity(f, products, dates, "2011-01-01")
    w = Window.partitionBy("customer_id")
    ranked = got.withColumn("r", F.row_number().over(w.orderBy(F.desc("total_product_revenue"), "product_id"))).withColumn(
        "f", F.row_number().over(w.orderBy(F.desc("times_purchased"), "product_id")))
    assert ranked.count() == 300
    assert ranked.where("r <> product_rank_by_revenue or f <> product_rank_by_frequency").count() == 0


def test_customer_days_need_a_known_product(spark):
    """A day on which only a product outside the dimension was bought counts nowhere."""
    f = T.fact(spark, [(DAYS[0], 1, "UK", 1, 1, 1, "2.00"), (DAYS[1], 99, "France", 1, 1, 1, "50.00")])
    row = CM.customer_lifetime_value(f, T.dates_of(spark, DAYS), T.products(spark, 1), "2011-01-01").head()
    assert (row["total_purchase_days"], row["total_product_purchases"], row["country"]) == (1, 1, "UK")
