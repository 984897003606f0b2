"""Batch run: file -> bronze -> silver -> gold -> checks."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tillworks.operators import customer_marts as CM
from tillworks.operators import quality, silver
from tillworks.operators import sales_marts as SM
from tillworks.sources import transactions as X
from tillworks.sources.layers import LayerStore, write_bronze
from tillworks.sources.workbooks import FIRST

Tables = dict[str, DataFrame]


def build_dimensions(store: LayerStore, bronze: DataFrame) -> None:
    store.replace(silver.dim_date(bronze), "silver.dim_date")
    store.replace(silver.dim_product(bronze), "silver.dim_product")


def build_fact(store: LayerStore, bronze: DataFrame) -> None:
    """The fact over the stored dimensions."""
    dates, products = store.read("silver.dim_date"), store.read("silver.dim_product")
    store.replace(silver.fact_sales_daily(bronze, dates, products), "silver.fact_sales_daily")


def upsert_fact(store: LayerStore, updates: DataFrame) -> None:
    """Replace or add fact rows by key, rewriting only the months they fall in."""
    store.upsert_partitions(
        updates, "silver.fact_sales_daily", silver.FACT_KEYS, ["year", "month"]
    )


def silver_tables(store: LayerStore, bronze: DataFrame) -> Tables:
    """Build and write the silver layer; returns it as read back."""
    build_dimensions(store, bronze)
    build_fact(store, bronze)
    return read_silver(store)


def read_silver(store: LayerStore) -> Tables:
    return {
        n: store.read(f"silver.{n}") for n in ["dim_date", "dim_product", "fact_sales_daily"]
    }


def gold_models(
    as_of: dt.date | str | None = None, count_unknown: bool = False
) -> dict[str, Callable[[Tables], DataFrame]]:
    """Every gold table over the silver ones, by name."""

    def over(fn, *names, **kw):
        return lambda t: fn(*[t[n] for n in names], **kw)

    f, d, p = "fact_sales_daily", "dim_date", "dim_product"
    return {
        "fact_sales_monthly": over(SM.sales_monthly, f, d, count_unknown=count_unknown),
        "fact_product_performance": over(SM.product_performance, f, p, d),
        "fact_country_sales": over(SM.country_sales, f, d, count_unknown=count_unknown),
        "fact_sales_daily_enhanced": lambda t: SM.day_over_day(SM.sales_daily_enhanced(t[f], t[d])),
        "monthly_sales_summary": over(SM.monthly_sales_summary, f, d),
        "top_products_by_revenue": over(SM.top_products_by_revenue, f, p),
        "country_performance": over(SM.country_performance, f, d),
        "customer_lifetime_value": over(CM.customer_lifetime_value, f, d, p, as_of=as_of),
        "customer_monthly_activity": over(CM.customer_monthly_activity, f, d),
        "customer_product_affinity": over(CM.customer_product_affinity, f, p, d, as_of=as_of),
    }


def build_gold(store: LayerStore, tables: Tables, as_of: dt.date | str | None = None) -> Tables:
    """Write every gold table; returns them as read back."""
    for name, model in gold_models(as_of, store.count_unknown).items():
        store.replace(model(tables), f"gold.{name}")
    return read_gold(store)


def read_gold(store: LayerStore) -> Tables:
    return {n: store.read(f"gold.{n}") for n in gold_models()}


def run(
    spark: SparkSession, source: str, root: str, fmt: str = "csv",
    as_of: dt.date | str | None = None, cleaning: str = "strict",
    date_formats: Sequence[str] = X.DATE_FORMATS, count_unknown: bool = False,
    sheets: str | Sequence[str] = FIRST,
) -> DataFrame:
    """Full refresh of every layer from the source; returns the checks' rows.

    Running it again on the same source gives the same tables.
    """
    store = LayerStore(spark, root, count_unknown=count_unknown)
    clean = {"strict": X.clean_strict, "lenient": X.clean_lenient}[cleaning]
    lines = clean(X.read_transactions(spark, source, fmt, sheets), date_formats)
    write_bronze(store, X.bronze_rows(lines, batch=str(uuid.uuid4())), mode="overwrite")
    bronze = store.read("bronze.raw_transactions")
    tables = silver_tables(store, bronze)
    tables |= build_gold(store, tables, as_of)
    return quality.suite({"raw_transactions": bronze} | tables)
