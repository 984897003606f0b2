"""Layers of a test-data folder, written once per application."""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillworks import schemas
from tillworks.plans import medallion
from tillworks.session import shared_folder
from tillworks.sources import testdata, transactions
from tillworks.sources.layers import LayerStore, write_bronze

_built: set[tuple[str, str, str]] = set()
_lock = threading.Lock()


def store_for(spark: SparkSession, sf_dir: str) -> LayerStore:
    digest = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:12]
    app = spark.sparkContext.applicationId
    return LayerStore(spark, f"{shared_folder(spark)}/tillworks/{app}/{digest}")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, empty place in the shared folder."""
    return f"{shared_folder(spark)}/tillworks/{purpose}-{uuid.uuid4()}"


def _once(spark: SparkSession, sf_dir: str, part: str, build: Callable[[LayerStore], None]) -> LayerStore:
    store = store_for(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), part)
    with _lock:
        if key not in _built:
            build(store)
            _built.add(key)
    return store


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored invoice lines of the folder: the order tables are joined once."""
    def build(store: LayerStore) -> None:
        rows = transactions.bronze_rows(testdata.bronze_lines(spark, sf_dir), "testdata")
        write_bronze(store, rows, mode="overwrite")

    return _once(spark, sf_dir, "bronze", build).read("bronze.raw_transactions").select(*schemas.BRONZE_LINE.names)


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored dim_date and dim_product of the folder."""
    lines = bronze(spark, sf_dir)
    store = _once(spark, sf_dir, "dimensions", lambda s: medallion.build_dimensions(s, lines))
    return store.read("silver.dim_date"), store.read("silver.dim_product")


def silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """dim_date, dim_product and fact_sales_daily of the folder.

    Gold reads stored silver, as it does in a batch run; invoice lines are joined
    and aggregated once per application instead of once per mart.
    """
    lines = bronze(spark, sf_dir)
    dimensions(spark, sf_dir)
    return medallion.read_silver(_once(spark, sf_dir, "fact", lambda s: medallion.build_fact(s, lines)))


def gold(spark: SparkSession, sf_dir: str, as_of: str) -> dict[str, DataFrame]:
    """Stored gold tables of the folder, as checks read them after a batch run."""
    tables = silver(spark, sf_dir)
    store = _once(spark, sf_dir, f"gold {as_of}", lambda s: medallion.build_gold(s, tables, as_of))
    return medallion.read_gold(store)
