"""Silver: two dimensions and the daily sales fact, from bronze invoice lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.functions import columns as C
from tillworks.operators.ranking import with_position


def dim_date(bronze: DataFrame, pg_padded: bool = False) -> DataFrame:
    """One row per day that has invoice lines (not a full calendar).

    ``pg_padded`` blank-pads the day and month names to nine characters.
    """
    days = (
        bronze.where(F.col("invoicedate").isNotNull())
        .select(F.to_date("invoicedate").alias("date"))
        .distinct()
    )

    def name(pattern: str) -> Column:
        text = F.date_format("date", pattern)
        return F.rpad(text, 9, " ") if pg_padded else text

    return days.select(
        C.date_id("date").alias("date_id"),
        "date",
        F.dayofmonth("date").alias("day"),
        name("EEEE").alias("day_name"),
        C.day_of_week("date").alias("day_of_week"),
        F.month("date").alias("month"),
        name("MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
        F.year("date").alias("year"),
        C.day_of_week("date").isin(0, 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def product_descriptions(bronze: DataFrame) -> DataFrame:
    """(stock_code, description): the smallest description of every code.

    Distinct pairs first: that is a hash aggregate with map-side combine, while
    MIN over a string directly on the lines would sort all of them.
    """
    pairs = (
        bronze.where(F.col("stockcode").isNotNull() & F.col("description").isNotNull())
        .select(F.col("stockcode").alias("stock_code"), "description")
        .distinct()
    )
    return pairs.groupBy("stock_code").agg(F.min("description").alias("description"))


def _product_rows(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "product_id",
        "stock_code",
        "description",
        C.product_category("stock_code").alias("category"),
    )


def dim_product(bronze: DataFrame) -> DataFrame:
    """One row per stock code that has a description; ids follow the code order."""
    codes = product_descriptions(bronze)
    return _product_rows(with_position(codes, ["stock_code"], "product_id"))


def extend_dim_product(existing: DataFrame, bronze: DataFrame) -> DataFrame:
    """Rows to append for codes not yet in the dimension.

    Known codes keep id and description; new ids continue after the largest.
    """
    fresh = product_descriptions(bronze).join(existing, "stock_code", "left_anti")
    last = existing.agg(F.coalesce(F.max("product_id"), F.lit(0)).alias("n")).scalar()
    return _product_rows(with_position(fresh, ["stock_code"], "product_id", last + 1))


def sale_lines(bronze: DataFrame) -> DataFrame:
    """Lines that count as sales: no returns, no negative price, country known."""
    return bronze.where(
        (F.col("quantity") > 0) & (F.col("unitprice") >= 0) & F.col("country").isNotNull()
    )


def fact_sales_daily(
    bronze: DataFrame, dates: DataFrame, products: DataFrame, numeric_customer: bool = False
) -> DataFrame:
    """Sales per (date, product, country).

    Lines are aggregated on their natural keys first and the dimension keys
    looked up afterwards: both dimensions are unique on theirs, so the result is
    the same and the joins see daily rows instead of invoice lines. COUNT
    DISTINCT shuffles on (group, invoice) before the group, which spreads a hot
    group over all tasks.

    A group's revenue belongs to its largest customer id, as in the source model.
    ``year`` and ``month`` are the storage partitions.
    """
    customer = C.parse_customer_id("customerid", numeric_customer)
    daily = (
        sale_lines(bronze)
        .groupBy(
            F.to_date("invoicedate").alias("date"), F.col("stockcode").alias("stock_code"), "country"
        )
        .agg(
            F.max(customer).alias("customer_id"),
            F.countDistinct("invoiceno").alias("total_transactions"),
            C.count_sum("quantity").alias("total_quantity"),
            C.line_revenue().cast("decimal(15,2)").alias("total_revenue"),
            F.avg("unitprice").cast("decimal(14,6)").alias("avg_unit_price"),
        )
    )
    return (
        daily.join(dates.select("date", "date_id", "year", "month"), "date")
        .join(products.select("stock_code", "product_id"), "stock_code")
        .select(
            "date_id", "product_id", "country", "customer_id", "total_transactions",
            "total_quantity", "total_revenue", "avg_unit_price", "year", "month",
        )
    )


FACT_KEYS = ["date_id", "product_id", "country"]
