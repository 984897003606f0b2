"""Operator 3, near-duplicates by SimHash: segment popcounts, a grid join, an exact check.

A fingerprint's 64 bits are cut into segments, and each segment is mapped to its number of set bits. One
differing bit moves one count by one, so the Manhattan distance of two count vectors never exceeds the number of
differing bits. The segments form groups; of d differing bits, one group holds at most d / groups, which is two
at most by the choice of groups. Two vectors at distance two or less have a grid point within one step of both.
Every distinct fingerprint therefore goes to its own grid point of each group and to all points one step away;
fingerprints that meet at a point are compared bit by bit.

Of a point only a spanning forest of its links leaves, never all pairs. Points with more than ``POINT_ROWS``
fingerprints are dealt out in pairs of chunks, so no task holds a large point.

Defined results: a null text and a text without words have fingerprint zero, linked like any other; equal texts
and repeated rows share a fingerprint; rows with a null id are linked like others and take their component's least
known id (null if there is none); an empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import in_batches, stored, table, vacate
from tillworks.llm.components import roots

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
SEGMENT_BITS = 2
POINT_ROWS = 4096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SUMMED = 255  # rows of byte counters that can be added without overflow


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash over the XXH64 of all word shingles, repeats included."""
    found = text.encode().translate(_LOWER).split() if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    w = min(words, len(found))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[s:e], SEED) for s, e in zip(starts[: len(found) - w + 1].tolist(), ends[w - 1 :].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        sums = np.add.reduceat(bits, np.arange(0, len(part), _SUMMED), axis=0)  # eight byte counters in a word
        counts += sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, same, fp): a hash of the text, and the fingerprint, both as signed BIGINT."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["id", "same", "fp"])

    in_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("same"), F.col(text_col).alias("t"))
    return own.mapInArrow(of_batch, f"id {kind}, same bigint, fp bigint")


def _grid_points(fp: Column, max_bits: int, segment: int) -> Column:
    """Points (group and packed counts in one BIGINT) of a fingerprint: its own, and all one step away."""
    if not 3 <= max_bits <= 32 or 64 % segment:
        raise ValueError("differing bits from 3 to 32, segments that divide 64 bits")
    groups = -(-(max_bits + 1) // 3)  # the least for which max_bits // groups is two at most
    segments = 64 // segment
    points = []
    for g in range(groups):
        mine = range(g * segments // groups, (g + 1) * segments // groups)
        mask, counts = F.lit((1 << segment) - 1), []
        for s in mine:
            bits = F.shiftrightunsigned(fp, s * segment).bitwiseAND(mask)
            counts.append(F.bit_count(bits).cast("bigint"))
        home = F.lit(0).cast("bigint")
        for i, c in enumerate(counts):
            home = home + F.shiftleft(c, i * segment)
        home = home + F.lit(g << (segments // groups * segment + segment))  # above the counts of any group
        steps = [F.when(c < segment, F.lit(1 << (i * segment))) for i, c in enumerate(counts)]
        steps += [F.when(c > 0, F.lit(-(1 << (i * segment)))) for i, c in enumerate(counts)]
        points += [home, *(home + step for step in steps)]
    return F.array_compact(F.array(*points))


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Unsigned on purpose: numpy counts the bits of a signed number's absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits


def _forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over fingerprints, by breadth first search over those not yet reached."""
    rest, a, b, queue = fps, [], [], []
    while len(rest) or queue:
        if queue:
            node = queue.pop()
        else:
            node, rest = rest[0], rest[1:]
        near = _near(rest, node, max_bits)
        if near.any():
            found = rest[near]
            a.append(np.full(len(found), node))
            b.append(found)
            queue.extend(found)
            rest = rest[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _links_of_points(points: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of whole points, rows sorted by point."""
    starts = np.flatnonzero(np.diff(points, prepend=points[0] - 1)) if len(points) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(points)))
    few = np.repeat(sizes <= 16, sizes)
    p, f = points[few], fps[few]
    a, b = [], []
    for shift in range(1, 16):
        same = p[shift:] == p[:-shift]
        if not same.any():
            break
        left, right = f[:-shift][same], f[shift:][same]
        near = _near(left, right, max_bits)
        a.append(left[near])
        b.append(right[near])
    for start, size in zip(starts[sizes > 16], sizes[sizes > 16]):
        mine = fps[start : start + size]
        if size <= 512 and _near(mine[:, None], mine[None, :], max_bits).sum() == size:
            continue  # no links
        x, y = _forest(mine, max_bits)
        a.append(x)
        b.append(y)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(a or none), np.concatenate(b or none)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, segment: int = SEGMENT_BITS, point_rows: int = POINT_ROWS) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (column fp) at ``max_bits`` or fewer differing bits."""
    met = distinct.select("fp", F.explode(_grid_points(F.col("fp"), max_bits, segment)).alias("point"))
    heavy = stored(met.groupBy("point").agg(F.count("*").alias("n")).where(F.col("n") > point_rows), "heavy-points")

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        kept_p, kept_f = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            p = np.concatenate([kept_p, batch.column(0).to_numpy()])
            f = np.concatenate([kept_f, batch.column(1).to_numpy()])
            last = int(np.searchsorted(p, p[-1])) if len(p) else 0  # the last point may go on in the next batch
            kept_p, kept_f = p[last:], f[last:]
            a, b = _links_of_points(p[:last], f[:last], max_bits)
            yield pa.RecordBatch.from_pydict({"a": a, "b": b})
        a, b = _links_of_points(kept_p, kept_f, max_bits)
        yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    def chunks(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        a, b = _forest(rows.column("fp").to_numpy(), max_bits)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    if heavy.isEmpty():
        return met.repartition("point").sortWithinPartitions("point").select("point", "fp").mapInArrow(light, "a bigint, b bigint")
    few = met.join(heavy.select("point"), "point", "left_anti").repartition("point").sortWithinPartitions("point")
    one = few.select("point", "fp").mapInArrow(light, "a bigint, b bigint")
    parts = F.ceil(F.col("n") * 2 / point_rows).cast("int")
    dealt = met.join(heavy, "point").select("point", "fp", parts.alias("c"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("i"))
    dealt = dealt.select("point", "fp", "i", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("j"))
    pairs = dealt.groupBy("point", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
    return one.union(pairs.applyInArrow(chunks, "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, same, fp, root, component_id) of each row of docs: root names the component by its least fingerprint."""
    of_docs = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = stored(of_docs.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    found = roots(links(distinct.select("fp"), max_bits))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return of_docs.join(rooted.join(ids, "root").select("fp", "root", "component_id"), "fp")


def representatives(found: DataFrame) -> DataFrame:
    """(id, same, n) of the row that stands for each component: the least known id, then the least text hash; n rows are equal in both."""
    first = F.struct(F.col("id").isNull().alias("none"), "id", "same")
    of_row = found.groupBy("root", "id", "same").agg(F.count("*").alias("n"))
    return of_row.groupBy("root").agg(F.min_by(F.struct("id", "same", "n"), first).alias("r")).select("r.*")


def op3_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
