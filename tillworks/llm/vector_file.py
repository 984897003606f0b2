"""Operator 2, exact top-k search by inner product over a vector-approximation file.

The file holds blocks of vectors: ids, one-byte cell numbers per component, and the exact integers in a column
of their own. A first scan reads ids and cells only and bounds every score from both sides by the corners of the
cells; the k-th highest lower bound of a query is a floor under its k-th result. A second scan visits, block by
block, the exact vectors whose upper bound reaches the floor, highest bound first, and stops as soon as the next
bound can't displace the k-th result. Queries are taken in rounds of bounded size against all blocks.

Defined results: a vector that is null or has a null or non-finite component, or has no id, takes no part; only
vectors of the query's own length are its candidates; rows with the query's id are its own and no candidates, and
several rows of one query id are one query (the least vector); other repeated rows are candidates each; ties go to
the smaller id; empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import stored, table

CELLS = 64  # per component, at most 256
BLOCK_VALUES = 1 << 18  # components in a block
ROUND_QUERIES = 2048  # queries that are sent to every task at once
EXACT = 2**53  # integers that doubles hold exactly

FILE = "block string, d int, n int, wide boolean, ids binary, cells binary, exact binary"


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as BIGINT."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def _ranges(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Lowest and highest integer of each component, by vector length; one row per task and length is combined."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                rows = _matrix(batch.column(1).filter(pa.array(lengths == d))).reshape(int((lengths == d).sum()), d)
                low, high = seen.get(d, (rows[0], rows[0]))
                seen[d] = [np.minimum(low, rows.min(0)), np.maximum(high, rows.max(0))]
        for d, (low, high) in seen.items():
            yield pa.RecordBatch.from_pydict({"d": [int(d)], "low": [low], "high": [high]}, pa.schema(
                [("d", pa.int32()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))]))

    parts = vectors.mapInArrow(of_task, "d int, low array<bigint>, high array<bigint>")
    by_place = parts.select("d", F.posexplode(F.arrays_zip("low", "high")).alias("i", "x")).groupBy("d", "i").agg(
        F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    out: dict[int, list] = {}
    nothing = np.zeros(0, np.int64)
    for d, i, low, high in by_place.orderBy("d", "i").collect():  # one row per component
        out.setdefault(d, []).append((low, high))
    return {0: (nothing, nothing)} | {d: tuple(np.array(x, np.int64).T) for d, x in out.items()}


class VectorFile:
    """The stored blocks and the ranges of their cells."""

    def __init__(self, blocks: DataFrame, ranges: dict[int, tuple[np.ndarray, np.ndarray]], cells: int):
        self.blocks, self.ranges, self.cells = blocks, ranges, cells

    @classmethod
    def build(cls, vectors: DataFrame, cells: int = CELLS) -> VectorFile:
        """Of columns id (BIGINT) and v (array of BIGINT)."""
        ranges = _ranges(vectors)

        def pack(name: str, ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
            low, high = ranges[rows.shape[1]]
            code = ((rows - low) // _width(low, high, cells)).astype(np.uint8)
            wide = bool(len(low) and max(np.abs(low).max(), np.abs(high).max()) >= 2**31)
            return pa.RecordBatch.from_pydict({
                "block": [name], "d": pa.array([rows.shape[1]], pa.int32()), "n": pa.array([len(ids)], pa.int32()), "wide": [wide],
                "ids": [ids.astype("<i8").tobytes()], "cells": [code.tobytes()], "exact": [rows.astype("<i8" if wide else "<i4").tobytes()]})

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, made, held = TaskContext.get().partitionId(), 0, {}
            for batch in batches:
                lengths = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
                for d in np.unique(lengths):
                    mine = pa.array(lengths == d)
                    ids, rows = held.setdefault(int(d), ([], []))
                    ids.append(batch.column(0).filter(mine).to_numpy(zero_copy_only=False))
                    rows.append(_matrix(batch.column(1).filter(mine)).reshape(int((lengths == d).sum()), d))
                    size = max(1, BLOCK_VALUES // max(1, int(d)))
                    if sum(map(len, ids)) >= size:
                        all_ids, all_rows = np.concatenate(ids), np.concatenate(rows)
                        while len(all_ids) >= size:
                            yield pack(f"{part}-{made}", all_ids[:size], all_rows[:size])
                            all_ids, all_rows, made = all_ids[size:], all_rows[size:], made + 1
                        held[int(d)] = ([all_ids], [all_rows])
            for ids, rows in held.values():
                if sum(map(len, ids)):
                    yield pack(f"{part}-{made}", np.concatenate(ids), np.concatenate(rows))
                    made += 1

        return cls(stored(vectors.mapInArrow(blocks, FILE), "vector-file"), ranges, cells)

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """query_id, rank, vec_id, score of each query's k highest inner products."""
        spark = queries.sparkSession
        asked = queries.groupBy("id").agg(F.min("v").alias("v"))
        rounds = max(1, -(-asked.count() // ROUND_QUERIES))
        found = None
        for r in range(rounds):
            mine = asked if rounds == 1 else asked.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == r)
            part = self._round([(row[0], row[1]) for row in mine.collect()], k)
            found = part if found is None else found.unionByName(part)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def _round(self, queries: list[tuple[int, list[int]]], k: int) -> DataFrame:
        ranges, cells = self.ranges, self.cells
        by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in {len(v) for _, v in queries}:
            mine = sorted((q, v) for q, v in queries if len(v) == d)
            by_length[d] = (np.array([q for q, _ in mine], np.int64), np.array([v for _, v in mine], np.int64).reshape(len(mine), d))

        def bounds(d: int, ids: np.ndarray, code: np.ndarray, upper: bool) -> np.ndarray:
            """A bound of every score, vectors by queries; -inf for a query's own rows."""
            low, high = ranges[d]
            names, q = by_length[d]
            width = _width(low, high, cells)
            floor = low + code.astype(np.int64) * width
            ceiling = np.minimum(floor + width - 1, high)
            a, b = (ceiling, floor) if upper else (floor, ceiling)
            q = q.astype(np.float64)
            out = a.astype(np.float64) @ np.maximum(q, 0).T + b.astype(np.float64) @ np.minimum(q, 0).T
            if not _safe(low, high, q):  # rounded: move the bound outwards
                slack = np.maximum(np.abs(floor), np.abs(ceiling)).astype(np.float64) @ np.abs(q).T * (d + 4) * 2.0**-52
                out = out + slack if upper else out - slack
            out[ids[:, None] == names[None, :]] = -np.inf
            return out

        def parts(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    if row["d"] in by_length:
                        yield row, np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["cells"], np.uint8).reshape(row["n"], row["d"])

        def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = {d: np.full((k, len(names)), -np.inf) for d, (names, _) in by_length.items()}
            for row, ids, code in parts(batches):
                both = np.concatenate([best[row["d"]], bounds(row["d"], ids, code, False)])
                best[row["d"]] = np.partition(both, len(both) - k, axis=0)[-k:]
            for d, (names, _) in by_length.items():
                yield pa.RecordBatch.from_pydict({"q": np.repeat(names, k), "bound": best[d].T.ravel()})

        # one row per task, query and place; the k-th highest of a query is its floor
        order = Window.partitionBy("q").orderBy(F.desc("bound"))
        kth = self.blocks.select("d", "n", "ids", "cells").mapInArrow(floors, "q bigint, bound double").withColumn(
            "place", F.row_number().over(order)).where(F.col("place") <= k)
        floor_of = dict(kth.where(F.col("place") == k).select("q", "bound").collect())  # a row per query of the round

        def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for row, ids, code in parts(batches):
                d = row["d"]
                names, q = by_length[d]
                exact = np.frombuffer(row["exact"], "<i8" if row["wide"] else "<i4").reshape(row["n"], d).astype(np.int64)
                if safe := _safe(*ranges[d], q):
                    exact, q = exact.astype(np.float64), q.astype(np.float64)
                upper = bounds(d, ids, code, True)
                reach = upper >= np.array([floor_of.get(int(x), -np.inf) for x in names])
                reach &= upper > -np.inf
                for j in np.flatnonzero(reach.any(axis=0)):
                    at = np.flatnonzero(reach[:, j])
                    at = at[np.lexsort((ids[at], -upper[at, j]))]
                    scores, found = best.get(int(names[j]), (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    done, step = 0, 64
                    while done < len(at):
                        bound, first = upper[at[done], j], ids[at[done]]
                        if len(found) == k and (scores[-1] > bound or scores[-1] == bound and found[-1] < first):
                            break
                        take = at[done : done + step]
                        new = exact[take] @ q[j]
                        scores = np.concatenate([scores, new.astype(np.int64) if safe else new])
                        found = np.concatenate([found, ids[take]])
                        keep = np.lexsort((found, -scores))[:k]
                        scores, found = scores[keep], found[keep]
                        done, step = done + step, step * 2
                    best[int(names[j])] = scores, found
            for name, (scores, found) in best.items():
                yield pa.RecordBatch.from_pydict({"query_id": np.full(len(found), name), "vec_id": found, "score": scores})

        return self.blocks.select("d", "n", "wide", "ids", "cells", "exact").mapInArrow(refine, "query_id bigint, vec_id bigint, score bigint")


def _width(low: np.ndarray, high: np.ndarray, cells: int) -> np.ndarray:
    return np.maximum(1, -(-(high - low + 1) // cells))


def _safe(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> bool:
    """Whether doubles hold every sum of products exactly."""
    if not q.size:
        return True
    return float(np.maximum(np.abs(low), np.abs(high)).max()) * float(np.abs(q).max()) * len(low) < EXACT


def op2_vector_file(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("id"), scaled(F.col("embedding")).alias("v"))
    return VectorFile.build(vectors).search(vectors.where("id % 50 = 0"), 5)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
