"""Gold: monthly, product, country and daily sales, over the fact and its dimensions.

Dimensions carry no broadcast hint: the planner broadcasts a side whose known
size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with
the size it measured; beyond it both fall back to a shuffled join.

Several distinct counts in one GROUP BY would send every fact row once for each
through the shuffle. Here sums go through the finest key that a count needs, and
every other distinct count is an aggregation of its own over two or three columns;
the results, one row per group, are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.functions import columns as C
from tillworks.operators.ranking import first_per_key


def _totals() -> list[Column]:
    """Sums of fact rows, or of partial sums under the same names."""
    return [
        C.money_sum("total_revenue").alias("total_revenue"),
        C.count_sum("total_quantity").alias("total_quantity"),
        C.count_sum("total_transactions").alias("total_transactions"),
    ]


def _per_transaction() -> list[Column]:
    return [
        C.safe_avg("total_revenue", "total_transactions").alias("avg_revenue_per_transaction"),
        C.safe_avg("total_quantity", "total_transactions").alias("avg_quantity_per_transaction"),
    ]


def _customer(count_unknown: bool) -> Column:
    return F.col("customer_id") if count_unknown else C.known_customer("customer_id")


def _counted(fact: DataFrame, keys: Sequence[str], value: Column | str, name: str) -> DataFrame:
    """COUNT(DISTINCT value) per group, NULL not counted; groups without a value have 0."""
    value = F.col(value) if isinstance(value, str) else value
    pairs = fact.select(*keys, value.alias("_value")).distinct()
    return pairs.groupBy(*keys).agg(F.count("_value").alias(name))


def _with_counts(sums: DataFrame, keys: Sequence[str], *counts: DataFrame) -> DataFrame:
    """Sums and counts of the same fact rows, so every group is in all of them."""
    for c in counts:
        sums = sums.join(c, list(keys))
    return sums


def _with_days(rows: DataFrame, key: str, days: str) -> DataFrame:
    """Totals, first and last date, mean price and distinct days of a key.

    Days are bits of a month's number first, so they add up without a distinct count.
    """
    months = rows.groupBy(key, "year", "month").agg(
        *_totals(),
        C.days_of_month().cast("bigint").alias("_days"),
        F.min("date").alias("_first"),
        F.max("date").alias("_last"),
        F.sum("avg_unit_price").alias("_price"),
        F.count("avg_unit_price").alias("_prices"),
    )
    return months.groupBy(key).agg(
        *_totals(),
        F.sum("_days").alias(days),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        _mean_price(F.sum("_price"), F.sum("_prices")).alias("avg_unit_price"),
    )


def _mean_price(total: Column, n: Column) -> Column:
    return F.round((total / F.nullif(n, F.lit(0))).cast("decimal(18,10)"), 2)


def _with_date(fact: DataFrame, dates: DataFrame, *cols: str) -> DataFrame:
    """Fact rows with date columns; the date's year and month replace the stored ones."""
    return fact.drop("year", "month").join(dates.select("date_id", *cols), "date_id")


def sales_monthly(fact: DataFrame, dates: DataFrame, count_unknown: bool = False) -> DataFrame:
    """Sales per (year, month).

    Transactions are summed over products, so an invoice with several products
    counts once for each. Cancellations are not in the fact: both columns are 0.
    """
    rows, month = _with_date(fact, dates, "year", "month"), ["year", "month"]
    products = rows.groupBy(*month, "product_id").agg(*_totals())
    sums = _with_counts(
        products.groupBy(*month).agg(*_totals(), F.count("product_id").alias("total_products")),
        month,
        _counted(rows, month, "country", "total_countries"),
        _counted(rows, month, _customer(count_unknown), "unique_customers"),
    )
    return sums.select(
        "year", "month", "total_revenue", "total_quantity", "total_transactions",
        "total_products", "total_countries", *_per_transaction(), "unique_customers",
        F.lit(0).cast("bigint").alias("cancelled_transactions"),
        F.lit(0).cast("decimal(18,2)").alias("cancelled_revenue"),
    )


def product_performance(fact: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales per product; product text is looked up after the aggregation."""
    rows = _with_date(fact, dates, "date", "year", "month", "day")
    sums = _with_counts(
        _with_days(rows, "product_id", "total_days_sold"), ["product_id"],
        _counted(rows, ["product_id"], "country", "total_countries"),
    ).withColumnsRenamed({"_first": "first_sale_date", "_last": "last_sale_date"})
    return sums.join(products, "product_id").select(
        "product_id", "stock_code", "description", "category", "total_revenue",
        "total_quantity", "total_transactions", "total_days_sold", "total_countries",
        C.safe_avg("total_revenue", "total_days_sold").alias("avg_revenue_per_day"),
        C.safe_avg("total_quantity", "total_days_sold").alias("avg_quantity_per_day"),
        *_per_transaction(), "first_sale_date", "last_sale_date",
    )


def _country_products(fact: DataFrame) -> DataFrame:
    return fact.groupBy("country", "product_id").agg(
        C.money_sum("total_revenue").alias("top_product_revenue")
    )


def top_product_per_country(fact: DataFrame) -> DataFrame:
    """Product with the most revenue per country; ties go to the smaller id."""
    best = first_per_key(
        _country_products(fact), ["country"],
        [F.desc("top_product_revenue"), F.asc("product_id")],
    )
    return best.select(
        "country", F.col("product_id").alias("top_product_id"), "top_product_revenue"
    )


def country_sales(fact: DataFrame, dates: DataFrame, count_unknown: bool = False) -> DataFrame:
    """Sales per country with its top product."""
    rows = _with_date(fact, dates, "date", "year", "month", "day")
    sums = _with_counts(
        _with_days(rows, "country", "total_days_active"), ["country"],
        _counted(rows, ["country"], "product_id", "total_products"),
        _counted(rows, ["country"], _customer(count_unknown), "unique_customers"),
    ).withColumnsRenamed({"_first": "first_transaction_date", "_last": "last_transaction_date"})
    return sums.join(top_product_per_country(fact), "country").select(
        "country", "total_revenue", "total_quantity", "total_transactions", "total_products",
        "total_days_active", "unique_customers", *_per_transaction(), "top_product_id",
        "top_product_revenue", "first_transaction_date", "last_transaction_date",
    )


def sales_daily_enhanced(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales per day; calendar columns are looked up after the aggregation."""
    day = ["date_id"]
    products = fact.groupBy(*day, "product_id").agg(*_totals())
    sums = _with_counts(
        products.groupBy(*day).agg(*_totals(), F.count("product_id").alias("total_products")),
        day,
        _counted(fact, day, "country", "total_countries"),
        _counted(fact, day, _customer(False), "unique_customers"),
    )
    return sums.join(dates, "date_id").select(
        "date_id", "date", "year", "month", "day_of_week", F.col("day").alias("day_of_month"),
        "quarter", F.weekofyear("date").alias("week_of_year"), "is_weekend", "total_revenue",
        "total_quantity", "total_transactions", "total_products", "total_countries",
        "unique_customers", *_per_transaction(),
    )


def day_over_day(daily: DataFrame) -> DataFrame:
    """Change against the previous trading day; the first day has none.

    The window has no partition: its input is one row per trading day, so the
    calendar bounds it (some 36,500 rows a century) whatever the sales volume.
    """
    w = Window.orderBy("date")
    out = daily
    for measure in ["revenue", "quantity", "transactions"]:
        now, before = F.col(f"total_{measure}"), F.lag(f"total_{measure}").over(w)
        change = F.col(f"{measure}_vs_previous_day")
        prev = F.col(f"_{measure}")
        out = (
            out.withColumn(f"_{measure}", before)
            .withColumn(f"{measure}_vs_previous_day", now - prev)
            .withColumn(
                f"{measure}_vs_previous_day_pct",
                F.when(prev > 0, F.round(C.divide(change * 100, prev), 2)),
            )
            .drop(f"_{measure}")
        )
    return out


def monthly_sales_summary(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales per month by name; the price is an average of the daily averages."""
    rows = _with_date(fact, dates, "year", "month", "month_name")
    month = ["year", "month", "month_name"]
    products = rows.groupBy(*month, "product_id").agg(
        *_totals(), F.sum("avg_unit_price").alias("_price"), F.count("avg_unit_price").alias("_prices")
    )
    sums = products.groupBy(*month).agg(
        F.count("product_id").alias("unique_products"),
        *_totals(),
        _mean_price(F.sum("_price"), F.sum("_prices")).alias("avg_unit_price"),
    )
    return (
        _with_counts(sums, month, _counted(rows, month, "country", "unique_countries"))
        .select(
            *month, "unique_products", "unique_countries", "total_transactions", "total_quantity",
            "total_revenue", "avg_unit_price",
        )
        .orderBy("year", "month")
    )


def top_products_by_revenue(fact: DataFrame, products: DataFrame, n: int = 100) -> DataFrame:
    """The n products with the most revenue; ties by stock code."""
    countries = fact.groupBy("product_id", "country").agg(*_totals())
    months = fact.groupBy("product_id", F.floor(F.col("date_id") / 100).alias("month")).agg(
        F.bit_count(F.bit_or(F.expr("shiftleft(1L, date_id % 100)"))).alias("days")
    )
    sums = _with_counts(
        countries.groupBy("product_id").agg(*_totals(), F.count("country").alias("countries_sold_in")),
        ["product_id"],
        months.groupBy("product_id").agg(F.sum("days").alias("days_sold")),
    ).join(products, "product_id")
    return (
        sums.select(
            "stock_code", "description", "category", "total_revenue", "total_quantity",
            "total_transactions", "days_sold", "countries_sold_in",
            C.ratio2("total_revenue", "total_quantity").alias("avg_revenue_per_unit"),
        )
        .orderBy(F.desc("total_revenue"), "stock_code")
        .limit(n)
    )


def country_performance(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales per country, most revenue first."""
    rows = _with_date(fact, dates, "date", "year", "month", "day")
    sums = _with_counts(
        _with_days(rows, "country", "active_days"), ["country"],
        _counted(rows, ["country"], "product_id", "unique_products"),
    ).withColumnsRenamed({"_first": "first_sale_date", "_last": "last_sale_date"})
    return sums.select(
        "country", "active_days", "unique_products", "total_transactions", "total_quantity",
        "total_revenue", "avg_unit_price",
        C.ratio2("total_revenue", "active_days").alias("avg_daily_revenue"),
        "first_sale_date", "last_sale_date",
    ).orderBy(F.desc("total_revenue"), "country")
