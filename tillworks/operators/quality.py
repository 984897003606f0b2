"""Data-quality checks.

A check is a row (check_name, failing_rows, passed). Checks that look at single
rows or at totals of one table run together in one scan (``table_checks``);
uniqueness and references each need a shuffle of their own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks import schemas
from tillworks.functions import columns as C
from tillworks.functions import rules


@dataclass(frozen=True)
class Check:
    """A named count of failing rows, as an aggregate over one table.

    ``per_row`` counts add up over parts of the table.
    """

    name: str
    failing: Column
    per_row: bool = False


def _row_check(name: str, bad: Column) -> Check:
    return Check(name, F.count_if(bad).cast("bigint"), per_row=True)


def _one_if(bad: Column) -> Column:
    """1 when a condition on totals is violated (or unknown), else 0."""
    return F.when(F.coalesce(bad, F.lit(True)), 1).otherwise(0).cast("bigint")


def not_null(col: str) -> Check:
    return _row_check(f"not_null:{col}", F.col(col).isNull())


def accepted_values(col: str, values: Sequence) -> Check:
    return _row_check(f"accepted_values:{col}", ~F.col(col).isin(list(values)))


def in_range(col: str, low=None, high=None) -> Check:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(col) < low)
    if high is not None:
        bad = bad | (F.col(col) > high)
    return _row_check(f"in_range:{col}", bad)


def max_length(col: str, n: int) -> Check:
    return _row_check(f"max_length:{col}", F.length(col) > n)


def customer_parses(col: str) -> Check:
    """Customer text that silver can only map to unknown."""
    return _row_check(f"customer_parses:{col}", C.is_junk_customer(col))


def has_rows() -> Check:
    return Check("has_rows", _one_if(F.count(F.lit(1)) == 0))


def positive_total(col: str) -> Check:
    return Check(f"positive_total:{col}", _one_if(F.sum(col) <= 0))


def date_bounds(col: str) -> Check:
    """Earliest and latest value exist, in order."""
    return Check(f"date_bounds:{col}", _one_if(F.min(col) > F.max(col)))


def distinct_present(col: str) -> Check:
    """At least one value (COUNT(DISTINCT) > 0 without counting them)."""
    return Check(f"distinct_present:{col}", _one_if(F.count(col) == 0))


_RESULT = ["check_name", "failing_rows", "passed"]


def _result(name: str, failing: DataFrame) -> DataFrame:
    return failing.select(
        F.lit(name).alias("check_name"),
        F.col("failing_rows").cast("bigint").alias("failing_rows"),
        (F.col("failing_rows") == 0).alias("passed"),
    )


def table_checks(
    df: DataFrame, table: str, checks: Sequence[Check], unique_key: str | None = None
) -> DataFrame:
    """All given checks of a table in one scan, one row each.

    ``unique_key`` adds that column's uniqueness to the same scan, for checks of
    single rows: they are counted per key first. A mart that is aggregated by
    the key already lies in the right partitions for that.
    """
    names = [c.name for c in checks]
    if unique_key is None:
        counts = df.agg(*[c.failing.alias(f"c{i}") for i, c in enumerate(checks)])
    else:
        if not all(c.per_row for c in checks):
            raise ValueError("checks of totals cannot share the scan of a unique key")
        per_key = df.groupBy(unique_key).agg(
            F.count(F.lit(1)).alias("n"), *[c.failing.alias(f"c{i}") for i, c in enumerate(checks)]
        )
        sums = [F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(len(checks))]
        repeated = F.col(unique_key).isNotNull() & (F.col("n") > 1)
        counts = per_key.agg(*sums, F.count_if(repeated).cast("bigint").alias(f"c{len(checks)}"))
        names.append(f"unique:{unique_key}")
    pairs = F.array(
        *[
            F.struct(
                F.lit(f"{table}.{name}").alias("check_name"), F.col(f"c{i}").alias("failing_rows")
            )
            for i, name in enumerate(names)
        ]
    )
    return counts.select(F.inline(pairs)).select(
        "check_name", "failing_rows", (F.col("failing_rows") == 0).alias("passed")
    )


def unique(df: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULL keys do not count."""
    keys = df.dropna(subset=list(cols)).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return _result(
        f"{table}.unique:{','.join(cols)}",
        keys.agg(F.coalesce(F.count_if(F.col("n") > 1), F.lit(0)).alias("failing_rows")),
    )


def relationships(
    child: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str | None = None
) -> DataFrame:
    """Child rows whose key is not in the parent.

    Child keys are counted before the join, so the join sees each key once and a
    hot key cannot skew it.
    """
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key or key).alias(key))
    orphans = keys.join(known, key, "left_anti")
    return _result(
        f"{table}.relationships:{key}",
        orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing_rows")),
    )


def columns_match(
    df: DataFrame, table: str, expected: Sequence[str], more: bool = False
) -> DataFrame:
    """Ordered column names equal the contract's; with ``more`` others may follow."""
    ok = (df.columns[: len(expected)] if more else df.columns) == list(expected)
    one = df.sparkSession.range(1).select(F.lit(0 if ok else 1).alias("failing_rows"))
    return _result(f"{table}.columns_match", one)


def union_checks(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results).select(*_RESULT)


def summarize(results: DataFrame) -> DataFrame:
    """(checks, passed, failed, ok) over a suite's rows."""
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    ).withColumn("ok", F.col("failed") == 0)


def reconcile_layers(bronze: DataFrame, fact: DataFrame) -> DataFrame:
    """Revenue and quantity of bronze sales against the fact's, one row.

    Both sides are single rows, met by scalar subqueries.
    """
    sales = bronze.where((F.col("quantity") > 0) & (F.col("unitprice") >= 0)).agg(
        C.line_revenue().alias("bronze_revenue"), C.count_sum("quantity").alias("bronze_quantity")
    )
    silver = fact.agg(
        C.money_sum("total_revenue").alias("r"), C.count_sum("total_quantity").alias("q")
    )
    return (
        sales.withColumn("silver_revenue", silver.select("r").scalar())
        .withColumn("silver_quantity", silver.select("q").scalar())
        .withColumn("revenue_matches", F.col("bronze_revenue").eqNullSafe(F.col("silver_revenue")))
        .withColumn(
            "quantity_matches", F.col("bronze_quantity").eqNullSafe(F.col("silver_quantity"))
        )
    )


def freshness(
    df: DataFrame, ts_col: str, now: dt.datetime | str | None = None,
    warn_hours: int = rules.FRESHNESS_WARN_HOURS, error_hours: int = rules.FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """Age of the newest row in whole hours and pass, warn or error."""
    clock = (
        F.current_timestamp().cast("timestamp_ntz")
        if now is None
        else F.lit(str(now)).cast("timestamp_ntz")
    )
    newest = df.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("newest"))
    age = newest.withColumn("age_hours", F.timestamp_diff("HOUR", F.col("newest"), clock))
    return age.withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass"),
    )


# --- the declared suite -----------------------------------------------------


def suite(tables: dict[str, DataFrame]) -> DataFrame:
    """Every declared check over the layers' tables, plus the validator's."""
    t = tables
    out = [
        table_checks(
            t["raw_transactions"], "raw_transactions",
            [not_null(c) for c in ["invoiceno", "stockcode", "invoicedate"]]
            + [has_rows(), in_range("unitprice", rules.MIN_PRICE, rules.MAX_PRICE)]
            + [distinct_present(c) for c in ["invoiceno", "stockcode", "country"]]
            + [date_bounds("invoicedate"), customer_parses("customerid")]
            + [max_length(c, n) for c, n in schemas.BRONZE_TEXT_LIMITS.items()],
        ),
        table_checks(
            t["dim_date"], "dim_date",
            [not_null(c) for c in ["date_id", "date", "is_weekend"]] + [has_rows()],
        ),
        unique(t["dim_date"], "dim_date", ["date_id"]),
        unique(t["dim_date"], "dim_date", ["date"]),
        table_checks(
            t["dim_product"], "dim_product",
            [not_null(c) for c in ["product_id", "stock_code", "category"]] + [has_rows()],
        ),
        unique(t["dim_product"], "dim_product", ["product_id"]),
        unique(t["dim_product"], "dim_product", ["stock_code"]),
        table_checks(
            t["fact_sales_daily"], "fact_sales_daily",
            [not_null(c) for c in ["date_id", "product_id", "total_revenue", "total_quantity"]]
            + [in_range(c, 0) for c in ["total_revenue", "total_quantity", "total_transactions"]]
            + [has_rows(), positive_total("total_revenue")],
        ),
        relationships(t["fact_sales_daily"], "fact_sales_daily", "date_id", t["dim_date"]),
        relationships(t["fact_sales_daily"], "fact_sales_daily", "product_id", t["dim_product"]),
        unique(t["fact_sales_daily"], "fact_sales_daily", ["date_id", "product_id", "country"]),
    ]
    out += [
        columns_match(t["raw_transactions"], "raw_transactions", schemas.BRONZE_LINE.names, more=True),
        *[columns_match(t[n], n, schemas.TABLES[f"silver.{n}"].names)
          for n in ["dim_date", "dim_product", "fact_sales_daily"]],
        *[columns_match(df, n, schemas.TABLES[f"ops.{n}"].names)
          for n, df in t.items() if f"ops.{n}" in schemas.TABLES],
    ]
    # Columns declared not null per mart.
    required = {
        "monthly_sales_summary": ["year", "month", "total_revenue"],
        "top_products_by_revenue": ["stock_code", "total_revenue"],
        "country_performance": ["country", "total_revenue"],
        "customer_lifetime_value": [
            "customer_id", "country", "total_lifetime_value", "total_orders", "customer_segment",
            "recency_category",
        ],
        "customer_monthly_activity": [
            "customer_id", "year", "month", "monthly_revenue", "monthly_orders",
            "customer_tenure_months",
        ],
        "customer_product_affinity": [
            "customer_id", "product_id", "stock_code", "total_product_revenue",
            "times_purchased", "affinity_level",
        ],
    }
    # Marts declared unique by a column.
    one_row_per = {"country_performance": "country", "customer_lifetime_value": "customer_id"}
    for mart, cols in required.items():
        checks = [not_null(c) for c in cols]
        if mart == "customer_lifetime_value":
            checks.append(accepted_values("customer_segment", rules.SEGMENTS))
        out.append(table_checks(t[mart], mart, checks, one_row_per.get(mart)))
    return union_checks(out)
