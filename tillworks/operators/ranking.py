"""Consecutive numbers over a whole table without one task sorting all of it."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.session import durable

# Rows that one task ranks for one group; a larger group is cut into RANGES.
GROUP_ROWS = 1 << 20
RANGES = 200

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def with_position(
    df: DataFrame, order: Sequence[Column | str], name: str, start: Column | int = 1
) -> DataFrame:
    """Add ``name`` = start, start+1, ... in the given total order.

    ``row_number`` over a window without partitions would move every row into
    one task. Here a range-partitioned sort numbers rows inside their partition
    and the partition's offset is added: only one count per partition meets in
    a single task. The sorted rows are made durable first, because range bounds
    are sampled and a second evaluation could cut the partitions elsewhere.
    """
    base = start if isinstance(start, Column) else F.lit(start)
    seq = F.monotonically_increasing_id()
    rows = durable(df.orderBy(*order).withColumn("_seq", seq)).select(
        "*",
        F.shiftright("_seq", _ROW_BITS).alias("_part"),
        F.col("_seq").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    # one row per partition of the sort: broadcast is bounded by the partition count
    return rows.join(F.broadcast(offsets), "_part").select(
        *df.columns, (base + F.col("_offset") + F.col("_row")).cast("bigint").alias(name)
    )


def with_group_position(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str
) -> DataFrame:
    """``row_number`` inside groups of any size, exact.

    The whole table is numbered by (group, order), so a group spreads over as
    many tasks as its rows need; the group's first number is then taken off.
    """
    placed = with_position(df, [*group, *order], "_place")
    first = placed.groupBy(*group).agg(F.min("_place").alias("_first"))
    return placed.join(first, list(group)).select(
        *df.columns, (F.col("_place") - F.col("_first") + 1).alias(name)
    )


def group_ranks(
    df: DataFrame,
    group: str,
    key: str,
    orders: dict[str, str],
    total: tuple[str, str],
    bound: int,
    most: int = GROUP_ROWS,
) -> DataFrame:
    """Ranks inside groups by several values (name: value, descending; then key), and a group total (name, column).

    ``key`` is unique inside a group and no group has more than ``bound`` rows. Up to
    ``most`` rows a group is ranked by one shuffle on the group and one sort per value.
    Where ``bound`` allows more, the rows are made durable and groups measured: larger
    ones are cut into ranges of the order, ranked there, and the sizes of the ranges
    before are added. Cuts are approximate percentiles; wherever they fall, equal places
    in the order share a range, so ranks are exact.
    """
    name, column = total
    small, large = df, None
    if bound > most:
        df = durable(df)
        sums = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.sum(column).alias(name)).where(F.col("_n") > most)
        small = df.join(sums.select(group), group, "left_anti")
        large = df.join(sums.drop("_n"), group)
        for rank, value in orders.items():
            large = large.join(_rank_by_ranges(df.join(sums.select(group), group), group, value, key, rank), [group, key])
    for k, (rank, value) in enumerate(orders.items()):
        order = Window.partitionBy(group).orderBy(F.desc(value), F.asc(key))
        small = small.withColumn(rank, F.row_number().over(order).cast("bigint"))
        if k == 0:  # on the rows as they are sorted now
            small = small.withColumn(name, F.sum(column).over(Window.partitionBy(group)))
    small = small.select(*df.columns, name, *orders)
    return small if large is None else small.unionByName(large.select(*small.columns))


def _rank_by_ranges(df: DataFrame, group: str, value: str, key: str, name: str) -> DataFrame:
    """(group, key, rank) of large groups, by (value descending, key ascending), from ranges of that order."""
    highest = df.groupBy(group).agg(F.max(key).alias("_top"))
    # a number that never falls along the order; the key, below one, tells equal values apart
    along = F.col(key).cast("double") / (F.col("_top").cast("double") + 1) - F.col(value).cast("double")
    along = F.coalesce(along, F.lit(sys.float_info.max))  # NULL comes last
    placed = df.join(highest, group).withColumn("_along", along)
    shares = [(i + 1) / RANGES for i in range(RANGES - 1)]
    cuts = placed.groupBy(group).agg(F.percentile_approx("_along", shares, 10 * RANGES).alias("_cuts"))
    placed = placed.join(cuts, group).withColumn(
        "_range", F.size(F.filter("_cuts", lambda c: c <= F.col("_along")))
    )
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        group, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )  # RANGES rows a group
    inside = Window.partitionBy(group, "_range").orderBy(F.desc(value), F.asc(key))
    ranked = placed.withColumn("_row", F.row_number().over(inside)).join(offsets, [group, "_range"])
    return ranked.select(group, key, (F.col("_row") + F.col("_before")).cast("bigint").alias(name))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """One row per key, the first in the given order.

    Catalyst plans row_number() = 1 as a WindowGroupLimit, which keeps one row
    per key in every map task before the shuffle, so a hot key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
