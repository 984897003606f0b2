"""Gold: lifetime value, monthly activity and product affinity of known customers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.functions import columns as C
from tillworks.functions import rules
from tillworks.operators.ranking import GROUP_ROWS, first_per_key, group_ranks


def _known(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("customer_id") != rules.UNKNOWN_CUSTOMER)


def _dated(fact: DataFrame, dates: DataFrame, *cols: str) -> DataFrame:
    return _known(fact).drop("year", "month").join(dates.select("date_id", *cols), "date_id")


def primary_country(fact: DataFrame) -> DataFrame:
    """Country with most of a customer's revenue; ties by name."""
    spend = (
        _known(fact)
        .groupBy("customer_id", "country")
        .agg(C.money_sum("total_revenue").alias("country_revenue"))
    )
    best = first_per_key(spend, ["customer_id"], [F.desc("country_revenue"), F.asc("country")])
    return best.select("customer_id", F.col("country").alias("primary_country"))


def _product_sums(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales per (customer, product): the base of affinity and lifetime value.

    One shuffle on the pair; both aggregations keep to it. Days are bits of their month
    first, so no distinct count shuffles the rows again. A hot customer's rows spread
    over its products, and a pair has a row per day and country at most.
    """
    months = (
        _dated(fact, dates, "date", "year", "month", "day")
        .repartition("customer_id", "product_id")
        .groupBy("customer_id", "product_id", "year", "month")
        .agg(
            C.days_of_month().alias("_days"),
            C.count_sum("total_transactions").alias("total_orders"),
            C.count_sum("total_quantity").alias("total_quantity_bought"),
            C.money_sum("total_revenue").alias("total_product_revenue"),
            F.count("total_revenue").alias("fact_rows"),
            F.max("total_revenue").alias("max_purchase_value"),
            F.min("date").alias("first_purchased_date"),
            F.max("date").alias("last_purchased_date"),
        )
    )
    return months.groupBy("customer_id", "product_id").agg(
        F.sum("_days").cast("bigint").alias("times_purchased"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_quantity_bought").alias("total_quantity_bought"),
        C.money_sum("total_product_revenue").alias("total_product_revenue"),
        F.sum("fact_rows").alias("fact_rows"),
        F.max("max_purchase_value").alias("max_purchase_value"),
        F.min("first_purchased_date").alias("first_purchased_date"),
        F.max("last_purchased_date").alias("last_purchased_date"),
    )


def customer_lifetime_value(
    fact: DataFrame, dates: DataFrame, products: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """One row per customer over all countries.

    Daily averages and maxima are per fact row, as named in the source model.

    Four distinct counts in one GROUP BY would send every fact row four times
    through the shuffle. Instead the counts add up along coarser groups: products
    and (day, product) pairs from the sums per product, days from day bits per
    month. A hot customer's rows spread over its products and months.
    """
    per_product = _product_sums(fact, dates).join(
        products.select("product_id", "category"), "product_id"
    )
    sums = per_product.groupBy("customer_id").agg(
        F.sum("times_purchased").alias("total_product_purchases"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_quantity_bought").alias("total_items_purchased"),
        C.money_sum("total_product_revenue").alias("total_lifetime_value"),
        F.sum("fact_rows").alias("fact_rows"),
        F.max("max_purchase_value").alias("max_daily_revenue"),
        F.min("first_purchased_date").alias("first_purchase_date"),
        F.max("last_purchased_date").alias("last_purchase_date"),
        F.count(F.lit(1)).alias("unique_products_purchased"),
        F.countDistinct("category").alias("unique_categories_purchased"),
    )
    sold = fact.join(products.select("product_id"), "product_id", "left_semi")
    days = (
        _dated(sold, dates, "year", "month", "day")
        .groupBy("customer_id", "year", "month")
        .agg(C.days_of_month().alias("days"))
        .groupBy("customer_id")
        .agg(F.sum("days").alias("total_purchase_days"))
    )
    lifespan = F.datediff("last_purchase_date", "first_purchase_date")
    idle_days = F.datediff(C.as_of_date(as_of), "last_purchase_date")
    zero = F.lit(0).cast("decimal(28,10)")
    return (
        sums.join(days, "customer_id")
        .join(primary_country(sold), "customer_id")
        .withColumn("customer_lifespan_days", lifespan)
        .select(
            "customer_id",
            F.col("primary_country").alias("country"),
            "total_purchase_days",
            "total_product_purchases",
            "total_orders",
            "total_items_purchased",
            "total_lifetime_value",
            C.divide("total_lifetime_value", "fact_rows").alias("avg_daily_revenue"),
            F.when(
                F.col("total_orders") > 0, C.divide("total_lifetime_value", "total_orders")
            ).otherwise(zero).alias("avg_order_value"),
            "max_daily_revenue",
            "unique_products_purchased",
            "unique_categories_purchased",
            "first_purchase_date",
            "last_purchase_date",
            "customer_lifespan_days",
            F.when(
                F.col("customer_lifespan_days") > 0,
                C.divide("total_purchase_days", "customer_lifespan_days"),
            ).otherwise(zero).alias("purchase_frequency"),
            C.customer_segment("total_lifetime_value").alias("customer_segment"),
            C.recency_bucket(idle_days).alias("recency_category"),
        )
    )


def customer_segment_counts(clv: DataFrame) -> DataFrame:
    return clv.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


def customer_recency_counts(clv: DataFrame) -> DataFrame:
    return clv.groupBy("recency_category").agg(F.count(F.lit(1)).alias("customers"))


def customer_monthly_activity(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per (customer, country, month).

    The windows see one row per month and country of a customer, so the calendar
    and the list of countries bound a group, not the sales volume. Tenure counts
    such rows, not calendar months. Months in several countries follow by name.
    """
    sums = (
        _dated(fact, dates, "date", "year", "month", "day")
        .groupBy("customer_id", "country", "year", "month")
        .agg(
            C.days_of_month().cast("bigint").alias("purchase_days_in_month"),
            F.countDistinct("product_id").alias("unique_products"),
            C.count_sum("total_transactions").alias("monthly_orders"),
            C.count_sum("total_quantity").alias("monthly_items"),
            C.money_sum("total_revenue").alias("monthly_revenue"),
            C.mean("total_revenue").alias("avg_daily_revenue"),
            F.max("total_revenue").alias("max_daily_revenue"),
            F.min("date").alias("first_purchase_in_month"),
            F.max("date").alias("last_purchase_in_month"),
        )
    )
    w = Window.partitionBy("customer_id").orderBy("year", "month", "country")
    prev = F.col("prev_month_revenue")
    return (
        sums.withColumn("prev_month_revenue", F.lag("monthly_revenue").over(w))
        .withColumn("customer_tenure_months", F.row_number().over(w).cast("bigint"))
        .select(
            "customer_id",
            "country",
            "year",
            "month",
            "purchase_days_in_month",
            "unique_products",
            "monthly_orders",
            "monthly_items",
            "monthly_revenue",
            "avg_daily_revenue",
            F.when(
                F.col("monthly_orders") > 0, C.divide("monthly_revenue", "monthly_orders")
            ).otherwise(F.lit(0).cast("decimal(28,10)")).alias("avg_order_value"),
            "max_daily_revenue",
            "prev_month_revenue",
            F.when(
                prev > 0, C.divide((F.col("monthly_revenue") - prev) * 100, prev)
            ).alias("revenue_growth_pct"),
            (F.col("customer_tenure_months") == 1).alias("is_first_month"),
            "customer_tenure_months",
            C.spending_level("monthly_revenue").alias("spending_level"),
            "first_purchase_in_month",
            "last_purchase_in_month",
        )
    )


def _ranked_products(sums: DataFrame, bound: int, most: int = GROUP_ROWS) -> DataFrame:
    """(customer, product) sums with the customer's spend and both ranks; ties go to the smaller product id."""
    return group_ranks(
        sums,
        "customer_id",
        "product_id",
        {
            "product_rank_by_revenue": "total_product_revenue",
            "product_rank_by_frequency": "times_purchased",
        },
        ("_spend", "total_product_revenue"),
        bound,
        most,
    )


def customer_product_affinity(
    fact: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """One row per (customer, product) with ranks inside the customer."""
    # before the ranks: only products of the dimension take part in them, so it bounds a customer
    bound = products.count()
    sums = _product_sums(fact, dates).join(products.select("product_id"), "product_id", "left_semi")
    span = F.datediff("last_purchased_date", "first_purchased_date")
    idle_days = F.datediff(C.as_of_date(as_of), "last_purchased_date")
    times = F.col("times_purchased")
    share = C.divide(F.col("total_product_revenue") * 100, "_spend")
    return (
        _ranked_products(sums, bound)
        .join(products, "product_id")
        .withColumn("days_buying_this_product", span)
        .withColumn("pct_of_customer_spend", share)
        .select(
            "customer_id",
            "product_id",
            "stock_code",
            "description",
            "category",
            "times_purchased",
            "total_orders",
            "total_quantity_bought",
            "total_product_revenue",
            C.divide("total_product_revenue", "fact_rows").alias("avg_purchase_value"),
            "max_purchase_value",
            "pct_of_customer_spend",
            F.col("product_rank_by_revenue").cast("bigint").alias("product_rank_by_revenue"),
            F.col("product_rank_by_frequency").cast("bigint").alias("product_rank_by_frequency"),
            F.when(
                F.col("days_buying_this_product") > 0,
                C.divide(times, F.col("days_buying_this_product") + 1),
            ).otherwise(times.cast("decimal(28,10)")).alias("purchase_frequency"),
            C.affinity_level(
                "product_rank_by_revenue", "pct_of_customer_spend", "times_purchased"
            ).alias("affinity_level"),
            "first_purchased_date",
            "last_purchased_date",
            "days_buying_this_product",
            C.product_recency(idle_days).alias("recency_category"),
        )
    )


def affinity_level_counts(affinity: DataFrame) -> DataFrame:
    return affinity.groupBy("affinity_level").agg(F.count(F.lit(1)).alias("pairs"))
