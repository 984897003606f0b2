"""Operator 11, hard negatives: rows of another label that score a little below an anchor's positives.

All vectors are numbered along a Hilbert curve over the components that vary most, sorted by it and packed into
blocks of ``BLOCK_ROWS`` rows. The blocks are stored as Parquet in row groups of their own; beside them a zone map
holds each block's least and greatest value of every component and its rows per label. Interval arithmetic over a
zone gives the least and greatest score that any of its rows can have with an anchor.

*Positives.* An anchor's floor is a score that enough rows of its label surely reach, from the zones' least scores;
it reads the blocks that hold its label and whose greatest score reaches the floor. *Windows.* With the positives
known, each anchor has windows of scores, from ``LEAST`` percent of a positive's score up to the score itself. For
every window the zones that lie in it as a whole give a floor in the same way, and the anchor reads the blocks
whose scores can lie between the floor and the window's upper end. Per pass, a block is read if some anchor needs
it and is compared with just those anchors; the other row groups are skipped by the scan's filters on the block's
number. Anchors are taken in rounds of ``ROUND_ANCHORS``, so what is sent to the tasks is bounded.

Defined results: rows with a null label, a null vector or null or non-finite components, or without an id, take no
part; only rows of an anchor's length are compared with it; rows with the anchor's id are its own and never its
positive or negative, and several rows of one anchor id are one anchor (the least label and vector); other
repeated rows are rows each; ties go to the smaller id, then to equal rows in any order; a positive score below
zero has an empty window; empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import in_ranges, row_groups, spans, stored, table
from tillworks.llm.vector_file import scaled, usable

BLOCK_ROWS = 128
CURVE_COMPONENTS = 16  # of a vector; the curve has four bits of each
ROUND_ANCHORS = 2048
POSITIVES = 5
NEGATIVES = 5
LEAST = 80  # percent of the positive's score

_BITS = 4


def hilbert(points: np.ndarray, bits: int = _BITS) -> np.ndarray:
    """Places of integer points (rows, components below 2**bits) on a Hilbert curve, as unsigned 64-bit numbers.

    Gray-code walk over the bits, most significant first: each step inverts or swaps the low bits of the axes so
    that neighbouring cells stay neighbours, after Skilling's description of the curve (2004).
    """
    x = points.T.astype(np.uint64).copy()
    n = len(x)
    top = np.uint64(1 << (bits - 1))
    q = top
    while q > 1:
        low = q - np.uint64(1)
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= np.uint64(1)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = np.zeros(x.shape[1], np.uint64), top
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - np.uint64(1), np.uint64(0))
        q >>= np.uint64(1)
    x ^= flip
    place = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << np.uint64(1) | (x[i] >> np.uint64(b) & np.uint64(1))
    return place


def bounds(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query (rows) with any vector of each zone (columns), exact integers."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _numbers(*arrays: np.ndarray) -> list[np.ndarray]:
    """Doubles where every sum of products is exact in them, else Python's integers."""
    most = [max(1.0, float(np.abs(x.astype(np.float64)).max(initial=0))) for x in arrays]
    exact = float(np.prod(most)) * arrays[0].shape[-1] < 2**53
    return [x.astype(np.float64 if exact else object) for x in arrays]


class Anchors(NamedTuple):
    """Anchors of one vector length with their windows: arrays of (anchors, windows)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    own: np.ndarray  # rows of the anchor's id
    lower: np.ndarray
    upper: np.ndarray


class ZonedFile:
    """The stored blocks and their zone maps."""

    def __init__(self, blocks: DataFrame, zones: DataFrame):
        self.blocks = blocks  # block, d, ids, labels, vectors
        self.zones = zones  # block, d, low, high, labels and rows of each

    @classmethod
    def build(cls, rows: DataFrame, block_rows: int = BLOCK_ROWS) -> ZonedFile:
        """Of columns id (BIGINT), label (INT) and v (array of BIGINT)."""
        rows = rows.withColumn("d", F.size("v"))
        spread = rows.select("d", F.posexplode("v").alias("i", "x")).groupBy("d", "i").agg(
            F.min("x").alias("low"), F.max("x").alias("high"), F.stddev_pop("x").alias("spread"))
        axes: dict[int, list] = {}
        for d, i, low, high, dev in spread.collect():  # a row per component
            axes.setdefault(d, []).append((-dev, i, low, high))
        chosen = {d: sorted(a)[:CURVE_COMPONENTS] for d, a in axes.items()}

        def on_curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = np.zeros(batch.num_rows, np.uint64)
                lengths = batch.column("d").to_numpy()
                for d in np.unique(lengths[lengths > 0]):
                    mine = lengths == d
                    v = batch.column("v").filter(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                    cell = [((v[:, i] - low).astype(np.float64) / (high - low + 1) * (1 << _BITS)).astype(np.int64) for _, i, low, high in chosen[d]]
                    place[mine] = hilbert(np.clip(np.stack(cell, axis=1), 0, (1 << _BITS) - 1))
                # the unsigned order as a signed number
                yield batch.append_column("place", pa.array((place ^ np.uint64(1 << 63)).view(np.int64)))

        sorted_rows = rows.select("id", "label", "v", "d").mapInArrow(on_curve, "id bigint, label int, v array<bigint>, d int, place bigint")
        sorted_rows = sorted_rows.repartitionByRange("d", "place", "id").sortWithinPartitions("d", "place", "id")
        # a block's number is that of its first row: ascending along the curve, and stored with it
        row = F.monotonically_increasing_id()
        named = sorted_rows.withColumn("block", row - row.bitwiseAND(F.lit((1 << 33) - 1)) % block_rows)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """One row per block and length; a partition's rows come in order."""
            held: list[pa.RecordBatch] = []

            def block_of(rows: pa.Table) -> pa.RecordBatch:
                d = rows.column("d")[0].as_py()
                v = rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, d)
                return pa.RecordBatch.from_arrays(
                    [pa.array([rows.column("block")[0].as_py()], pa.int64()), pa.array([d], pa.int32()),
                     pa.array([rows.column("id").to_numpy()], pa.list_(pa.int64())), pa.array([rows.column("label").to_numpy()], pa.list_(pa.int32())),
                     pa.array([v.ravel()], pa.list_(pa.int64())), pa.array([v.min(axis=0)], pa.list_(pa.int64())), pa.array([v.max(axis=0)], pa.list_(pa.int64()))],
                    names=["block", "d", "ids", "labels", "vectors", "low", "high"])

            def cut(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
                block, d = rows.column("block").to_numpy(), rows.column("d").to_numpy()
                ends = [*(np.flatnonzero((np.diff(block) != 0) | (np.diff(d) != 0)) + 1).tolist(), len(block)]
                start = 0
                for end in ends if last else ends[:-1]:
                    yield block_of(rows.slice(start, end - start))
                    start = end
                held[:] = [] if last else rows.slice(start).to_batches()

            for batch in batches:
                if batch.num_rows:
                    yield from cut(pa.Table.from_batches([*held, batch]), False)
            if held:
                yield from cut(pa.Table.from_batches(held), True)

        packed = named.mapInArrow(pack, "block bigint, d int, ids array<bigint>, labels array<int>, vectors array<bigint>, low array<bigint>, high array<bigint>")
        blocks = row_groups(packed, "hilbert-blocks", 1)
        counts = F.transform(F.array_sort(F.array_distinct("labels")), lambda x: F.struct(x.alias("label"), F.size(F.filter("labels", lambda y: y == x)).alias("n")))
        zones = stored(blocks.select("block", "d", "low", "high", counts.alias("labels")), "zone-maps")
        return cls(blocks.select("block", "d", "ids", "labels", "vectors"), zones)

    def best(self, anchors: dict[int, Anchors], n: int, same: bool) -> DataFrame:
        """(anchor, place, rank, id, score): the n best rows of each anchor's windows, of its label (``same``) or of others."""
        lower = self._floors(anchors, n, same)

        def of_zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The zones that may hold what a window of an anchor seeks, with those anchors."""
            for d, blocks, least, most, count in _zones(batches, anchors, same):
                a = anchors[d]
                low, high = lower[d], a.upper
                reach = np.zeros(count.shape, bool)
                for place in range(low.shape[1]):
                    reach |= (most >= low[:, place, None]) & (least <= high[:, place, None]) & (low[:, place] <= high[:, place])[:, None]
                reach &= count > 0
                at = np.flatnonzero(reach.any(axis=0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[at]), pa.array(np.full(len(at), d, np.int32)), pa.array([np.flatnonzero(reach[:, z]) for z in at], pa.list_(pa.int32()))],
                    names=["block", "d", "anchors"])

        needed = stored(self.zones.mapInArrow(of_zones, "block bigint, d int, anchors array<int>"), "needed-blocks")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for row in range(batch.num_rows):
                    d = batch.column("d")[row].as_py()
                    ids, labels, v, mine = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("ids", "labels", "vectors", "anchors"))
                    a, low = anchors[d], lower[d]
                    x, q = _numbers(v.reshape(len(ids), d), a.vectors[mine])
                    scores = q @ x.T
                    wanted = ((labels == a.labels[mine, None]) == same) & (ids != a.ids[mine, None])
                    for k, anchor in enumerate(mine.tolist()):
                        for place in range(low.shape[1]):
                            at = np.flatnonzero(wanted[k] & (scores[k] >= low[anchor, place]) & (scores[k] <= a.upper[anchor, place]))
                            if len(at):
                                old = kept.get((d, anchor, place), (np.zeros(0, scores.dtype), np.zeros(0, np.int64)))
                                s, i = np.concatenate([old[0], scores[k][at]]), np.concatenate([old[1], ids[at]])
                                first = sorted(range(len(s)), key=lambda r: (-s[r], i[r]))[:n]
                                kept[d, anchor, place] = s[first], i[first]
            for (d, anchor, place), (s, i) in kept.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), anchors[d].ids[anchor])), pa.array(np.full(len(s), place, np.int32)), pa.array(i),
                     pa.array([int(x) for x in s], pa.int64())], names=["anchor", "place", "id", "score"])

        read = self.blocks.where(in_ranges("block", spans(needed, "block")))
        found = read.join(needed, ["block", "d"]).mapInArrow(compare, "anchor bigint, place int, id bigint, score bigint")
        first = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n).select("anchor", "place", "rank", "id", "score")

    def _floors(self, anchors: dict[int, Anchors], n: int, same: bool) -> dict[int, np.ndarray]:
        """The windows' lower ends, raised to a score that n rows surely reach: those of zones that lie in the window as a whole."""

        def of_zones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for d, _, least, most, count in _zones(batches, anchors, same):
                a = anchors[d]
                for k, place in np.ndindex(a.upper.shape):
                    inside = np.flatnonzero((count[k] > 0) & (most[k] <= a.upper[k, place]) & (least[k] > a.lower[k, place]))
                    if len(inside):
                        inside = inside[np.argsort(-least[k][inside].astype(np.float64), kind="stable")]
                        inside = inside[: int(np.searchsorted(np.cumsum(count[k][inside]), n + a.own[k])) + 1]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(inside), a.ids[k])), pa.array(np.full(len(inside), place, np.int32)), pa.array(np.full(len(inside), n + a.own[k])),
                             pa.array([int(x) for x in least[k][inside]], pa.int64()), pa.array(count[k][inside])], names=["anchor", "place", "due", "least", "n"])

        sure = self.zones.mapInArrow(of_zones, "anchor bigint, place int, due bigint, least bigint, n bigint")
        best_first = Window.partitionBy("anchor", "place").orderBy(F.desc("least")).rowsBetween(Window.unboundedPreceding, 0)
        reached = sure.withColumn("rows", F.sum("n").over(best_first)).where("rows >= due").groupBy("anchor", "place").agg(F.max("least"))
        raised = {(a, p): x for a, p, x in reached.collect()}  # a row per window of the round
        out = {d: a.lower.copy() for d, a in anchors.items()}
        for d, a in anchors.items():
            for k, place in np.ndindex(a.lower.shape):
                out[d][k, place] = max(a.lower[k, place], raised.get((int(a.ids[k]), place), a.lower[k, place]))
        return out


def _zones(batches: Iterator[pa.RecordBatch], anchors: dict[int, Anchors], same: bool) -> Iterator[tuple]:
    """(length, blocks, least scores, greatest scores, rows that count) of the zones of each length; arrays of (anchors, zones)."""
    for batch in batches:
        rows = batch.to_pylist()
        for d in {r["d"] for r in rows} & set(anchors):
            mine, a = [r for r in rows if r["d"] == d], anchors[d]
            low, high = (np.array([r[c] for r in mine], np.int64).reshape(len(mine), d) for c in ("low", "high"))
            (low, q), (high, _) = _numbers(low, a.vectors), _numbers(high, a.vectors)
            count = np.zeros((len(a.ids), len(mine)), np.int64)
            for z, r in enumerate(mine):
                for part in r["labels"]:
                    count[:, z] += part["n"] * ((a.labels == part["label"]) == same)
            least, most = bounds(low, high, q)
            yield d, np.array([r["block"] for r in mine], np.int64), least, most, count


def _by_length(rows: list, windows: dict[int, list[tuple]], places: int) -> dict[int, Anchors]:
    out = {}
    for d in {len(r["v"]) for r in rows}:
        mine = [r for r in rows if len(r["v"]) == d]
        ends = [(windows.get(r["id"], []) + [(np.inf, -np.inf)] * places)[:places] for r in mine]
        out[d] = Anchors(
            np.array([r["id"] for r in mine], np.int64), np.array([r["label"] for r in mine], np.int32),
            np.array([r["v"] for r in mine], np.int64).reshape(len(mine), d), np.array([r["own"] for r in mine], np.int64),
            *(np.array([[w[side] for w in e] for e in ends], object).reshape(len(mine), places) for side in (0, 1)))
    return out


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; rows and anchors of columns id, label, v."""
    rows = stored(rows.select("id", "label", "v"), "labelled-vectors")
    file = ZonedFile.build(rows)
    own = rows.groupBy("id").agg(F.count("*").alias("own"))
    asked = anchors.groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select("id", "a.label", "a.v").join(own, "id")
    asked = stored(asked, "anchors")
    rounds = max(1, -(-asked.count() // ROUND_ANCHORS))
    parts = []
    for r in range(rounds):
        taken = asked.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == r).collect()
        first = stored(file.best(_by_length(taken, {x["id"]: [(-np.inf, np.inf)] for x in taken}, 1), positives, True), "positives")
        windows: dict[int, list[tuple]] = {}
        for x in first.orderBy("anchor", "rank").collect():  # so many a round, by anchor
            windows.setdefault(x["anchor"], []).append((-(-least * x["score"] // 100), x["score"]))
        found = file.best(_by_length(taken, windows, positives), negatives, False)
        of_place = first.select("anchor", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        parts.append(stored(found.join(of_place, ["anchor", "place"]).select(
            F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op11_hard_negatives(spark, sf_dir):
    usable_rows = table(spark, sf_dir, "embeddings").where(usable(F.col("embedding")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    rows = usable_rows.select(F.col("vec_id").cast("bigint").alias("id"), label.alias("label"), scaled(F.col("embedding")).alias("v"))
    return mine(rows, rows.where("id % 100 = 0"))


SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
