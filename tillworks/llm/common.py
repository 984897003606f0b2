"""What several operators share: tables, stored intermediate results, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.plans.workspace import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]

# Rows of whole texts that travel to a Python worker at once.
BATCH_ROWS = 400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, compression: str = "zstd", batch_rows: int | None = None, **options: object) -> DataFrame:
    """df written once to the shared folder and read again: lineage is cut there.

    ``batch_rows`` is the size of Arrow batches while it is written; the session's own setting comes back afterwards.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    folder = fresh_folder(spark, purpose)
    before = spark.conf.get(key)
    if batch_rows:
        spark.conf.set(key, str(batch_rows))
    try:
        df.write.options(compression=compression, **options).parquet(folder)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(folder)


def row_groups(df: DataFrame, purpose: str, rows: int) -> DataFrame:
    """df stored with so many rows in a Parquet row group: a filter on a sorted column skips the others."""
    return stored(df, purpose, **{"parquet.block.row.count.limit": rows})


def in_ranges(column: str, ranges: Iterable[tuple[int, int]], most: int = 200) -> Column:
    """A filter for whole ranges (from, to) that reaches the scan; of more than ``most``, the closest are joined."""
    ordered = sorted(ranges)
    if not ordered:
        return F.lit(False)
    gaps = sorted(((b[0] - a[1], i + 1) for i, (a, b) in enumerate(zip(ordered, ordered[1:]))), reverse=True)[: most - 1]
    cuts = sorted(i for gap, i in gaps if gap > 1)
    parts = [F.col(column).between(ordered[s][0], max(r[1] for r in ordered[s:e])) for s, e in zip([0, *cuts], [*cuts, len(ordered)])]
    while len(parts) > 1:  # a flat tree of ORs
        parts = [a | b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) - len(parts) % 2 :]
    return parts[0]


def spans(numbers: DataFrame, column: str, most: int = 4096) -> list[tuple[int, int]]:
    """Ranges that hold all numbers of a column: some ``most`` of them at the most, so a bounded list for the driver."""
    low, high = numbers.agg(F.min(column), F.max(column)).first()
    if low is None:
        return []
    step = F.lit(-(-(high - low + 1) // most))
    part = F.floor((F.col(column) - low) / step)
    return [(a, b) for a, b in numbers.groupBy(part.alias("part")).agg(F.min(column), F.max(column)).select("min(" + column + ")", "max(" + column + ")").collect()]


def in_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of whole texts small; the default is 10,000 rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fresh_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """The wanted column names, with underscores in front as long as the input has such a column."""
    names, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in names:
            name = "_" + name
        names.add(name.lower())
        out.append(name)
    return out


_resident: dict = {}


def resident(key: object, make: Callable[[], object]) -> object:
    """The one large object (a model, a vocabulary) that a Python worker holds; another key replaces it."""
    if key not in _resident:
        vacate()
        _resident[key] = make()
    return _resident[key]


def vacate() -> None:
    """Give a worker's large object and free Arrow memory back before other work."""
    import pyarrow as pa

    _resident.clear()
    pa.default_memory_pool().release_unused()
