"""Keyed table operators: upsert, insert-if-absent, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.operators.ranking import first_per_key


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with whole rows of ``updates`` replacing or joining them by key.

    ``updates`` must hold a key once; see ``find_duplicate_keys``, ``keep_latest``.
    """
    kept = target.join(updates.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(updates.select(*target.columns))


def insert_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows plus those of ``rows`` whose key is new."""
    fresh = rows.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def find_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("duplicate_count")).where("duplicate_count > 1")
    )


def keep_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """The newest row of every key; ``order`` lists what makes a row newer.

    Other keys stay untouched.
    """
    return first_per_key(df, keys, [F.desc(c) if isinstance(c, str) else c for c in order])
