"""Summaries and published listings over the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import columns as C
from tillworks.functions import rules


def _sold(bronze: DataFrame) -> DataFrame:
    return bronze.where(F.col("quantity") > 0)


def _rows(name: str):
    return F.count(F.lit(1)).alias(name)


# --- bronze -----------------------------------------------------------------


def bronze_summary(bronze: DataFrame) -> DataFrame:
    """One row: rows, distinct keys, date range, revenue of sold lines.

    Each distinct count is a scan of one column; together they would send every
    line once for each through the shuffle.
    """
    def different(name: str) -> Column:
        return bronze.select(name).distinct().agg(F.count(name)).scalar()

    cents = (F.col("unitprice") * 100).cast("bigint") * F.col("quantity")
    sold_cents = F.sum(F.when(F.col("quantity") > 0, cents)).cast("decimal(19,0)")
    totals = bronze.agg(
        _rows("total_records"),
        F.min("invoicedate").alias("first_transaction"),
        F.max("invoicedate").alias("last_transaction"),
        (sold_cents / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)").alias("total_revenue"),
    )
    return totals.select(
        "total_records",
        different("invoiceno").alias("unique_invoices"),
        different("stockcode").alias("unique_products"),
        different("customerid").alias("unique_customers"),
        different("country").alias("unique_countries"),
        "first_transaction", "last_transaction", "total_revenue",
    )


def ingest_count_check(df: DataFrame, expected: int | DataFrame) -> DataFrame:
    """One row: did at least 95 % of the expected rows arrive, and how many are missing.

    ``expected`` is a number or a frame whose rows are counted.
    """
    if isinstance(expected, DataFrame):
        wanted = expected.agg(F.count(F.lit(1)).alias("n")).scalar()
    else:
        wanted = F.lit(expected).cast("bigint")
    counted = df.agg(_rows("actual_rows")).withColumn("expected_rows", wanted)
    return counted.select(
        "expected_rows",
        "actual_rows",
        (F.col("expected_rows") - F.col("actual_rows")).alias("missing_rows"),
        (F.col("actual_rows") >= F.col("expected_rows") * F.lit(rules.INGEST_TOLERANCE)).alias(
            "passed"
        ),
    )


def layer_row_counts(tables: dict[str, DataFrame], ordered: bool = True) -> DataFrame:
    """(table_name, row_count) of every given table."""
    counts = [df.agg(_rows("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in tables.items()]
    out = reduce(DataFrame.unionByName, counts)
    return out.orderBy("table_name") if ordered else out


def silver_metrics(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Row counts of the silver tables and total revenue, one row."""
    return fact.agg(
        _rows("fact_rows"), C.money_sum("total_revenue").alias("total_revenue")
    ).select(
        dates.agg(F.count(F.lit(1))).scalar().alias("date_rows"),
        products.agg(F.count(F.lit(1))).scalar().alias("product_rows"),
        "fact_rows",
        "total_revenue",
    )


def bronze_revenue_by_country(bronze: DataFrame, n: int = 10) -> DataFrame:
    return (
        _sold(bronze)
        .groupBy("country")
        .agg(_rows("transaction_count"), C.line_revenue().alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "country")
        .limit(n)
    )


def bronze_top_products(bronze: DataFrame, n: int = 10) -> DataFrame:
    return (
        _sold(bronze)
        .groupBy("stockcode", "description")
        .agg(
            _rows("transaction_count"),
            C.count_sum("quantity").alias("total_quantity"),
            C.line_revenue().alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "stockcode", "description")
        .limit(n)
    )


def bronze_daily_volume(bronze: DataFrame) -> DataFrame:
    """Lines and revenue per day, returns included."""
    return (
        bronze.groupBy(F.to_date("invoicedate").alias("transaction_date"))
        .agg(_rows("transaction_count"), C.line_revenue().alias("daily_revenue"))
        .orderBy("transaction_date")
    )


def bronze_customer_analysis(bronze: DataFrame, n: int = 10) -> DataFrame:
    return (
        bronze.where(F.col("customerid").isNotNull())
        .groupBy("customerid")
        .agg(
            F.countDistinct("invoiceno").alias("invoice_count"),
            C.line_revenue().alias("total_spent"),
            F.min("invoicedate").alias("first_purchase"),
            F.max("invoicedate").alias("last_purchase"),
        )
        .orderBy(F.desc("total_spent"), "customerid")
        .limit(n)
    )


# --- silver -----------------------------------------------------------------


def _by_date(fact: DataFrame, dates: DataFrame, *aggs) -> DataFrame:
    """Aggregates per day; the date is looked up for the few daily rows."""
    return (
        fact.groupBy("date_id").agg(*aggs).join(dates.select("date_id", "date"), "date_id").drop(
            "date_id"
        )
    )


def silver_daily_rollup(fact: DataFrame, dates: DataFrame, n: int = 10) -> DataFrame:
    """Latest n days."""
    days = _by_date(
        fact, dates,
        C.money_sum("total_revenue").alias("daily_revenue"),
        C.count_sum("total_quantity").alias("daily_quantity"),
        C.count_sum("total_transactions").alias("daily_transactions"),
    )
    return days.orderBy(F.desc("date")).limit(n)


def silver_top_products(fact: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """By description, which several products may share."""
    per_product = fact.groupBy("product_id").agg(
        C.money_sum("total_revenue").alias("total_revenue"),
        C.count_sum("total_quantity").alias("total_quantity"),
    )
    return (
        per_product.join(products.select("product_id", "description"), "product_id")
        .groupBy("description")
        .agg(
            C.money_sum("total_revenue").alias("total_revenue"),
            C.count_sum("total_quantity").alias("total_quantity"),
        )
        .orderBy(F.desc("total_revenue"), "description")
        .limit(n)
    )


def silver_daily_revenue(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return _by_date(fact, dates, C.money_sum("total_revenue").alias("daily_revenue")).orderBy("date")


def silver_revenue_by_country(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("country")
        .agg(
            C.money_sum("total_revenue").alias("total_revenue"),
            F.countDistinct("date_id").alias("active_days"),
        )
        .orderBy(F.desc("total_revenue"), "country")
    )


# --- gold -------------------------------------------------------------------


def gold_weekday_analysis(daily: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        daily.select("date_id", "total_revenue", "total_transactions")
        .join(dates.select("date_id", "day_of_week", "day_name"), "date_id")
        .groupBy("day_of_week", "day_name")
        .agg(
            _rows("days"),
            C.money_sum("total_revenue").alias("total_revenue"),
            C.mean("total_revenue").alias("avg_daily_revenue"),
            C.count_sum("total_transactions").alias("total_transactions"),
        )
        .orderBy("day_of_week")
    )


def gold_month_name_revenue(monthly: DataFrame, dates: DataFrame) -> DataFrame:
    """Monthly revenue by month name.

    Joined to distinct months: the published listing joins every day of the
    month and so multiplies the revenue by the number of trading days.
    """
    names = dates.select("year", "month", "month_name").distinct()
    return (
        monthly.join(names, ["year", "month"])
        .groupBy("year", "month", "month_name")
        .agg(
            C.money_sum("total_revenue").alias("monthly_revenue"),
            C.count_sum("total_quantity").alias("monthly_quantity"),
        )
        .orderBy("year", "month")
    )


def gold_monthly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "year", "month", "total_revenue", "total_quantity", "total_transactions",
        "avg_revenue_per_transaction",
    ).orderBy(F.desc("year"), F.desc("month"))


def gold_latest_months(monthly: DataFrame, n: int = 10) -> DataFrame:
    return monthly.orderBy(F.desc("year"), F.desc("month")).limit(n)


def gold_top10_products(products: DataFrame, n: int = 10) -> DataFrame:
    return (
        products.select(
            "stock_code", "description", "category", "total_revenue", "total_quantity",
            "total_transactions", "avg_revenue_per_transaction",
        )
        .orderBy(F.desc("total_revenue"), "stock_code")
        .limit(n)
    )


def gold_country_ranking(countries: DataFrame, n: int | None = None) -> DataFrame:
    ranked = countries.select(
        "country", "total_revenue", "total_quantity", "total_transactions",
        "avg_revenue_per_transaction",
    ).orderBy(F.desc("total_revenue"), "country")
    return ranked if n is None else ranked.limit(n)


def gold_daily_trend_30(trend: DataFrame, n: int = 30) -> DataFrame:
    """Latest n days of the day-over-day table."""
    return (
        trend.select(
            "date", "day_of_week", "is_weekend", "total_revenue", "revenue_vs_previous_day",
            "revenue_vs_previous_day_pct",
        )
        .orderBy(F.desc("date"))
        .limit(n)
    )


def gold_product_listing(products: DataFrame, n: int = 10) -> DataFrame:
    return (
        products.select(
            "stock_code", "description", "total_revenue", "total_quantity", "total_transactions"
        )
        .orderBy(F.desc("total_revenue"), "stock_code")
        .limit(n)
    )


def gold_country_listing(countries: DataFrame, n: int = 10) -> DataFrame:
    return (
        countries.select("country", "total_revenue", "total_quantity", "total_transactions")
        .orderBy(F.desc("total_revenue"), "country")
        .limit(n)
    )


def gold_latest_days(trend: DataFrame, n: int = 10) -> DataFrame:
    return (
        trend.select(
            "date", "total_revenue", "revenue_vs_previous_day", "revenue_vs_previous_day_pct",
            "is_weekend",
        )
        .orderBy(F.desc("date"))
        .limit(n)
    )


def cancellations_by_month(bronze: DataFrame) -> DataFrame:
    """Cancelled invoices and their value per month: returns or a 'C' invoice number."""
    cancelled = (F.col("quantity") < 0) | F.upper("invoiceno").startswith("C")
    return (
        bronze.where(cancelled)
        .groupBy(F.year("invoicedate").alias("year"), F.month("invoicedate").alias("month"))
        .agg(
            F.countDistinct("invoiceno").alias("cancelled_transactions"),
            C.line_revenue().alias("cancelled_revenue"),
        )
    )
