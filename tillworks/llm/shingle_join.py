"""Operator 12, n-gram Jaccard join: documents whose sets of word shingles overlap almost wholly.

Two sets of sizes a and b reach a Jaccard similarity of ``PERCENT`` only if few of their a + b shingles are not
shared: a nineteenth of them at 90 %. Shingles are hashed into groups, and a set becomes
the vector of its group counts. Of two sets, the summed minima of the counts are an upper bound of the overlap,
so the Manhattan distance of two vectors is a lower bound of the number of shingles that are not shared.

*Trees.* Sets are taken in classes of similar size; a set whose partner may fall into the next class is a guest
there. The groups of a class are cut into bands of ``DIMENSIONS`` counts, so many that two linked sets differ by
one at most in some band: each (class, band) is an R-tree of its own over the different count vectors of the band.
Two vectors one step apart agree in the upper or the lower half of their counts, so a tree of more than ``BOX_ROWS``
vectors is split into boxes twice, by the counts of either half: a vector lies in two boxes, however many there
are, and shares one of them with each vector a step away. Inside a box, vectors that share that half with no other
are left aside, and the others, sorted, are packed into pages of ``FANOUT``, pages into nodes, each with its least and greatest counts; a node is
entered only if the summed minima of the vector and the node's greatest counts leave overlap enough. Vectors one
step apart, and sets of one vector, meet, at the vector of more sets. Of the meetings of just the same sets one is kept.

*Bounds, then sets.* Sets that meet are compared by a longer count vector (``LONG`` groups of the whole set); only
pairs whose summed minima reach the needed overlap go on to the exact intersection, for which the texts of those
sets alone are shuffled: a bitmap of their hashes keeps nearly all others back. Pairs are never spelled out
for a whole meeting at first: two rounds take a spanning forest of each meeting's surviving pairs, check it
exactly and name the components found so far; the last round then takes every surviving pair whose sets are still
in different components. Only sets that a round's forests name go on to the next. Meetings of more than ``MEETING_ROWS`` sets are dealt out in pairs of chunks.

Equal sets are joined once, by a 128-bit digest; shingles are compared by their 64-bit hashes. No row is sampled,
capped or left out.

Defined results: a null text and a text without words have the empty set, linked with nothing; rows with a null id
take part and take their component's least known id (null if there is none); repeated rows have equal sets; an
empty table gives an empty result. Only the id and the text are read; texts are taken whole.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import BATCH_ROWS, stored, table, vacate
from tillworks.llm.components import roots

WORDS = 3
PERCENT = 90
DIMENSIONS = 32  # counts of a band, two bits each in unary: present in the upper half of 64 bits, twice or more in the lower
LONG = 128
BOX_ROWS = 1 << 12
FANOUT = 8
MEETING_ROWS = 1024
FEW = 16  # sets of a meeting whose pairs are all compared at once
BATCH_ROWS_OF_SETS = 1 << 12  # members with their count vectors, the same
BATCH_NUMBERS = 1 << 16  # rows without texts that travel to a Python worker at once
FOREST_ROUNDS = 2
BITS = 16  # of the bitmap, for each wanted set
BITMAP_WORDS = 1 << 18  # of 64 bits, at most
PAIRS_OF_SETS = 64  # whole sets of both, that travel to a Python worker at once

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the different shingles; all words as one where there are fewer."""
    found = text.translate(_LOWER).split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    joined, w = b" ".join(found), min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh3_64_intdigest
    spans = zip(starts[: len(found) - w + 1].tolist(), ends[w - 1 :].tolist())
    return np.unique(np.fromiter((digest(joined[s:e]) for s, e in spans), np.uint64))


class Classes:
    """Size classes: class k holds sizes from ``least[k]`` up to the next; its bands are enough for all its pairs."""

    def __init__(self, percent: int = PERCENT):
        if not 50 <= percent < 100:
            raise ValueError("a similarity from 50 to 99 percent")
        self.percent = percent
        # 100 i >= percent (a + b - i), so a + b - 2 i <= (a + b) lost / whole
        self.lost, self.whole = 100 - percent, 100 + percent
        first = -(-self.whole // (2 * self.lost))  # below, only equal sets link
        self.least = [first]
        while self.least[-1] < 1 << 40:
            self.least.append(self.least[-1] * 3 // 2)

    def bands(self, k: int) -> int:
        return 2 * (self.least[k + 1] - 1) * self.lost // self.whole // 2 + 1

    def of(self, n: int) -> list[int]:
        """The class of a size, and further ones where a larger partner may be."""
        k = int(np.searchsorted(self.least, n, "right")) - 1
        guest = int(np.searchsorted(self.least, 100 * n // self.percent, "right")) - 1
        return [c for c in range(k, guest + 1) if c >= 0]

    def enough(self, a: np.ndarray, b: np.ndarray, overlap: np.ndarray) -> np.ndarray:
        return (100 + self.percent) * overlap >= self.percent * (a + b)


def pack(counts: np.ndarray) -> np.ndarray:
    """Rows of counts as 64-bit numbers; counts stop at two, which makes distances smaller only."""
    place = np.arange(DIMENSIONS, dtype=np.uint64)
    bits = (counts > 0).astype(np.uint64) << (place + np.uint64(32)) | (counts > 1).astype(np.uint64) << place
    return np.bitwise_or.reduce(bits, axis=1).view(np.int64)


def band_vectors(hashes: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """(tree, packed counts) of each band of each class that a set is in; tree numbers hold the class and the band."""
    trees, vectors = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    group = (hashes >> np.uint64(59)).astype(np.int64)
    for k in classes.of(len(hashes)):
        m = classes.bands(k)
        cell = (hashes % np.uint64(m)).astype(np.int64) * DIMENSIONS + group
        counts = np.bincount(cell, minlength=m * DIMENSIONS).reshape(m, DIMENSIONS)
        trees.append((k << 40) + np.arange(m, dtype=np.int64))
        vectors.append(pack(counts))
    return np.concatenate(trees), np.concatenate(vectors)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays)))


def features(docs: DataFrame, id_col: str, text_col: str, words: int, classes: Classes) -> DataFrame:
    """(id, same, n, sid, trees, vectors, long) of each document: hash of text and id, set size, digest of the set, counts of the bands and of the whole set."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        for batch in batches:
            if not batch.num_rows:
                continue
            n, sid, trees, vectors, long = [], [], [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py(), words)
                t, v = band_vectors(found, classes)
                n.append(len(found))
                sid.append(xxhash.xxh3_128_digest(found.tobytes()))
                trees.append(t)
                vectors.append(v)
                long.append(np.bincount(((found >> np.uint64(32)) % np.uint64(LONG)).astype(np.int64), minlength=LONG).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sid, pa.binary()), _lists(trees), _lists(vectors), _lists(long)], names=["id", "same", "n", "sid", "trees", "vectors", "long"])

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col, id_col).alias("same"), F.col(text_col).cast("binary").alias("t"))
    return own.mapInArrow(of_batch, f"id {kind}, same bigint, n bigint, sid binary, trees array<bigint>, vectors array<bigint>, long array<int>")


class PackedTree:
    """R-tree over sorted vectors: level 0 are the vectors, each further level the least and greatest counts of ``FANOUT`` below.

    Counts are unary, so least and greatest counts are ANDs and ORs, and a sum of minima is the number of common bits.
    """

    def __init__(self, vectors: np.ndarray):
        low = high = vectors.view(np.uint64)
        least = most = np.bitwise_count(low).astype(np.int8)
        self.levels = [(low, high, least, most)]
        while len(low) > FANOUT:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((low, high, least, most))

    def above(self, vectors: np.ndarray, rows: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of the stored vectors that exceed a query by one in one count."""
        top, found = len(self.levels[-1][0]), [np.zeros((2, 0), np.int64)]
        step = max(1, rows // max(1, top))
        for first in range(0, len(vectors), step):
            x = vectors[first : first + step].view(np.uint64)
            total = np.bitwise_count(x).astype(np.int8)
            query, node = np.repeat(np.arange(len(x)), top), np.tile(np.arange(top), len(x))
            for level in range(len(self.levels) - 1, -1, -1):
                low, high, least, most = self.levels[level]
                q, sum_q = x[query], total[query]
                # a vector one above has all of the query's counts as overlap, and one node count too many at most
                fits = (np.bitwise_count(q & high[node]) == sum_q) & (np.bitwise_count(low[node] & ~q) <= 1)
                fits &= (least[node] <= sum_q + 1) & (most[node] > sum_q)
                query, node = query[fits], node[fits]
                if level:
                    query = np.repeat(query, FANOUT)
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    inside = node < len(self.levels[level - 1][0])
                    query, node = query[inside], node[inside]
            found.append(np.stack([query + first, node]))
        return tuple(np.concatenate(found, axis=1))


_UPPER = 0xFFFF0000FFFF0000  # bits of the upper half of a vector's counts


def _swapped(vector: np.ndarray) -> np.ndarray:
    """Vectors with the halves of their counts in each other's place."""
    bits, upper, half = vector.view(np.uint64), np.uint64(_UPPER), np.uint64(16)
    return ((bits & upper) >> half | (bits & ~upper) << half).view(np.int64)


def boxes(vectors: DataFrame, box_rows: int) -> DataFrame:
    """(tree, box, vector, sets) from (tree, vector, sets): boxes by the upper half of the counts; in odd ones vectors are swapped.

    Trees of ``box_rows`` vectors at most are one box, -1; the others' number of boxes is broadcast, a row for each.
    """
    upper = F.lit(_UPPER - (1 << 64))
    large = vectors.groupBy("tree").agg(F.ceil(F.count("*") / box_rows).alias("many")).where("many > 1")
    v = F.col("vector")
    swapped = F.shiftrightunsigned(v.bitwiseAND(upper), 16).bitwiseOR(F.shiftleft(v.bitwiseAND(F.bitwise_not(upper)), 16))
    sides = F.when(F.col("many").isNull(), F.array(v)).otherwise(F.array(v, swapped))
    both = vectors.join(F.broadcast(large), "tree", "left").select("tree", "sets", "many", F.posexplode(sides).alias("side", "vector"))
    box = F.pmod(F.xxhash64(v.bitwiseAND(upper)), F.col("many")) * 2 + F.col("side")
    return both.select("tree", F.coalesce(box, F.lit(-1).cast("bigint")).alias("box"), "vector", "sets")


def one_above(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of the sorted vectors of the same upper half, one of which exceeds the other by one in one count."""
    _, key, sharing = np.unique(vectors.view(np.uint64) & np.uint64(_UPPER), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(sharing[key] > 1)
    query, place = (shared[x] for x in PackedTree(vectors[shared]).above(vectors[shared]))
    same = key[query] == key[place]
    return query[same], place[same]


def meetings(points: DataFrame, box_rows: int = BOX_ROWS) -> DataFrame:
    """(tree, centre, vector, own, sets): vectors of a tree that meet at a stored vector, itself included, two sets at least; a centre may come twice.

    ``own`` and ``sets`` are the numbers of sets of the centre and of the vector.
    """
    vectors = stored(points.groupBy("tree", "vector").agg(F.count("*").alias("sets")), "band-vectors")

    def of_box(tree: int, box: int, vectors: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, ...]:
        query, place = one_above(vectors)
        if box < 0:  # the whole tree: pairs that agree in the other half, too
            order = np.argsort(swapped := _swapped(vectors))
            query, place = (np.concatenate([x, order[y]]) for x, y in zip((query, place), one_above(swapped[order])))
        elif box % 2:
            vectors = _swapped(vectors)
        centre = sets > 1
        centre[place] = True
        at, of = (np.concatenate([x, np.flatnonzero(centre)]) for x in (place, query))
        return np.full(len(at), tree), vectors[at], vectors[of], sets[at], sets[of]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        kept: list[list[np.ndarray]] = []
        names = ["tree", "box", "vector", "sets"]

        def done(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            tree, box, vector, sets = rows
            cuts = np.flatnonzero((np.diff(tree) != 0) | (np.diff(box) != 0)) + 1
            for s, e in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(tree)]])):
                if e > s:
                    out = of_box(tree[s], box[s], vector[s:e], sets[s:e])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["tree", "centre", "vector", "own", "sets"])

        for batch in batches:
            rows = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            if not len(rows[0]):
                continue
            last = int(np.flatnonzero((rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]))[0])  # its box may go on in the next batch
            if last or kept and (kept[-1][0][-1] != rows[0][0] or kept[-1][1][-1] != rows[1][0]):
                yield from done([np.concatenate(x) for x in zip(*kept, [x[:last] for x in rows])])
                kept = []
            kept.append([x[last:] for x in rows])
        if kept:
            yield from done([np.concatenate(x) for x in zip(*kept)])

    dealt = boxes(vectors, box_rows).repartition("tree", "box").sortWithinPartitions("tree", "box", "vector")
    return stored(dealt.mapInArrow(search, "tree bigint, centre bigint, vector bigint, own bigint, sets bigint"), "meetings", batch_rows=BATCH_NUMBERS)


def at_the_larger(met: DataFrame) -> DataFrame:
    """(tree, centre, vector): of two vectors one step apart the one of more sets is the centre, so many sets of one vector
    stay in their own meeting and are not taken to that of each rare neighbour."""
    centre, vector, turned = F.col("centre"), F.col("vector"), F.col("sets") > F.col("own")
    return met.select("tree", F.when(turned, vector).otherwise(centre).alias("centre"), F.when(turned, centre).otherwise(vector).alias("vector"))


def different(members: DataFrame) -> DataFrame:
    """The members (meeting, key) of one meeting of all that hold just the same keys, two at least.

    Similar sets meet in most of their bands: without this, each pair would be compared there again. The keys of a
    meeting are told by two 64-bit sums without carry and their number.
    """
    members = stored(members, "all-members")
    first, second = F.bit_xor("key").alias("x"), F.bit_xor(F.xxhash64("key")).alias("y")
    held = members.groupBy("meeting").agg(F.count("*").alias("sets"), first, second).where("sets > 1")
    return members.join(held.groupBy("sets", "x", "y").agg(F.min("meeting").alias("meeting")).select("meeting"), "meeting")


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of a matrix of links, first rows first: meetings of much the same sets then name the same pairs."""
    rest, a, b = np.arange(len(near)), [], []
    while len(rest):
        queue, rest = deque([rest[0]]), rest[1:]
        while queue:
            node = queue.popleft()
            hit = near[node, rest]
            for x in rest[hit].tolist():
                a.append(node)
                b.append(x)
                queue.append(x)
            rest = rest[~hit]
    return np.array(a, np.int64), np.array(b, np.int64)


def _survivors(n: np.ndarray, long: np.ndarray, root: np.ndarray, other: slice | None, mine: slice, classes: Classes) -> np.ndarray:
    """Matrix of the pairs in different components whose summed minima leave overlap enough."""
    theirs = mine if other is None else other
    out = root[mine, None] != root[None, theirs]
    for k in np.flatnonzero(out.any(axis=1)):
        at = np.flatnonzero(out[k])
        size = n[theirs][at]
        own = n[mine][k]
        at, size = at[(sized := 100 * np.minimum(size, own) >= classes.percent * np.maximum(size, own))], size[sized]
        overlap = np.minimum(long[theirs][at], long[mine][k]).sum(axis=1, dtype=np.int64)
        out[k] = False
        out[k, at[classes.enough(size, own, overlap)]] = True
    return out


def candidates(members: DataFrame, forest: bool, classes: Classes, meeting_rows: int = MEETING_ROWS) -> DataFrame:
    """(a, b) digests of sets that meet, pass the bound and are in different components; members: meeting, sid, n, long, root."""

    def large(n: np.ndarray, long: np.ndarray, root: np.ndarray, cut: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs of one meeting, or, with ``cut``, of those between its two chunks."""
        if cut is None:
            near = _survivors(n, long, root, None, slice(None), classes)
            return _forest(near) if forest else np.nonzero(np.triu(near, 1))
        near = _survivors(n, long, root, slice(cut, None), slice(0, cut), classes)
        if not forest:
            x, y = np.nonzero(near)
            return x, y + cut
        whole = np.zeros((len(n), len(n)), bool)
        whole[:cut, cut:] = near
        return _forest(whole | whole.T)

    def arrays(rows: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        rows = rows.combine_chunks()
        long = rows.column("long").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, LONG)
        root = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
        return rows.column("sid").combine_chunks(), rows.column("n").to_numpy(), long, root

    def whole_meetings(rows: pa.Table) -> pa.RecordBatch:
        sid, n, long, root = arrays(rows)
        meeting = rows.column("meeting").to_numpy()
        starts = np.flatnonzero(np.diff(meeting, prepend=meeting[0] - 1))
        sizes = np.diff(np.append(starts, len(meeting)))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at = np.flatnonzero(np.repeat(sizes <= FEW, sizes))
        for shift in range(1, FEW):
            x, y = at[:-shift], at[shift:]
            same = (meeting[x] == meeting[y]) & (root[x] != root[y])
            x, y = x[same], y[same]
            sized = 100 * np.minimum(n[x], n[y]) >= classes.percent * np.maximum(n[x], n[y])
            x, y = x[sized], y[sized]
            for k in range(0, len(x), 1 << 14):
                i, j = x[k : k + (1 << 14)], y[k : k + (1 << 14)]
                near = classes.enough(n[i], n[j], np.minimum(long[i], long[j]).sum(axis=1, dtype=np.int64))
                a.append(i[near])
                b.append(j[near])
        for s, size in zip(starts[sizes > FEW].tolist(), sizes[sizes > FEW].tolist()):
            mine = slice(s, s + size)
            x, y = large(n[mine], long[mine], root[mine], None)
            a.append(x + s)
            b.append(y + s)
        return out(sid, np.concatenate(a), np.concatenate(b))

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            meeting = batch.column("meeting").to_numpy()
            last = int(np.searchsorted(meeting, meeting[-1]))  # it may go on in the next batch
            if last or kept and kept[-1].column("meeting")[-1].as_py() != meeting[0]:
                yield whole_meetings(pa.Table.from_batches([*kept, batch.slice(0, last)]))
                kept = []
            kept.append(batch.slice(last))
        if kept:
            yield whole_meetings(pa.Table.from_batches(kept))

    def out(sid: pa.Array, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([sid.take(pa.array(a)), sid.take(pa.array(b))], names=["a", "b"])

    def of_chunks(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lo, hi = key[1].as_py(), key[2].as_py()
        rows, cut = rows.sort_by("sid"), None
        if lo < hi:
            parts = [rows.filter(pc.equal(rows.column("i"), c)) for c in (lo, hi)]
            rows, cut = pa.concat_tables(parts), parts[0].num_rows
        sid, n, long, root = arrays(rows)
        return pa.Table.from_batches([out(sid, *large(n, long, root, cut))])

    open_ones = members.groupBy("meeting").agg(F.count("*").alias("members"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    open_ones = stored(open_ones.select("meeting", "members"), "open-meetings")
    taken = members.join(open_ones, "meeting")
    few = taken.where(F.col("members") <= meeting_rows).select("meeting", "sid", "n", "long", "root")
    found = few.repartition("meeting").sortWithinPartitions("meeting", "sid").mapInArrow(light, "a binary, b binary")
    if not open_ones.where(F.col("members") > meeting_rows).isEmpty():
        parts = F.ceil(F.col("members") * 2 / meeting_rows).cast("int")
        dealt = taken.where(F.col("members") > meeting_rows).select(
            "meeting", "sid", "n", "long", "root", parts.alias("c"), F.pmod(F.xxhash64("sid"), parts).cast("int").alias("i"))
        dealt = dealt.select("meeting", "sid", "n", "long", "root", "i", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("j"))
        chunks = dealt.groupBy("meeting", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"))
        found = found.union(chunks.applyInArrow(of_chunks, "a binary, b binary"))
    return stored(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "candidates", batch_rows=BATCH_ROWS_OF_SETS)


def links(pairs: DataFrame, sets: DataFrame, classes: Classes) -> DataFrame:
    """The pairs whose sets (sid, hashes) overlap enough, by exact intersection."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(h.as_buffer(), np.uint64) for h in (x, y))
                keep.append(bool(classes.enough(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("sid").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("sid").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return stored(both.mapInArrow(verify, "a binary, b binary"), "set-links", batch_rows=PAIRS_OF_SETS)


def likely(rows: DataFrame, wanted: DataFrame, most: int = BITMAP_WORDS) -> DataFrame:
    """Rows whose hash ``same`` is twice in a bitmap of the wanted ones: all that are wanted and few others."""
    words = min(most, wanted.count() * BITS // 64 + 1)
    places = [F.pmod(h, F.lit(64 * words)) for h in (F.col("same"), F.xxhash64("same"))]
    set_bits = wanted.select(F.explode(F.array(*places)).alias("place")).select(F.floor(F.col("place") / 64).alias("word"), (F.col("place") % 64).cast("int").alias("bit"))
    bitmap = F.broadcast(set_bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
    for place in places:
        met = rows.withColumn("word", F.floor(place / 64)).join(bitmap, "word")
        rows = met.where(F.getbit("bits", place % 64) == 1).select(*rows.columns)
    return rows


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(sid, hashes) of the wanted sets, from the whole text of one document each; wanted: sid, id, same."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [shingles(t.as_py(), words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.binary())], names=["sid", "hashes"])

    wanted = stored(wanted, "wanted-sets")
    named = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col, id_col).alias("same"), F.col(text_col).cast("binary").alias("__t"))
    key = (F.col("d.same") == F.col("w.same")) & F.col("__id").eqNullSafe(F.col("id"))
    one = likely(named, wanted).alias("d").join(wanted.alias("w"), key).select("sid", "__t").dropDuplicates(["sid"])
    return stored(one.mapInArrow(of_batch, "sid binary, hashes binary"), "sets", batch_rows=BATCH_ROWS)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, root, component_id) of each row: root is the digest that names its component."""
    classes = Classes(percent)
    of_docs = stored(features(docs, id_col, text_col, words, classes), "shingle-features", batch_rows=BATCH_ROWS)
    distinct = stored(of_docs.where("n > 0").select("id", "same", "n", "sid", "trees", "vectors", "long").dropDuplicates(["sid"]), "shingle-sets")
    key = F.xxhash64("sid").alias("key")
    points = distinct.select(key, F.explode(F.arrays_zip("trees", "vectors")).alias("p")).select("key", F.col("p.trees").alias("tree"), F.col("p.vectors").alias("vector"))
    met = at_the_larger(meetings(points))
    member = points.join(met, ["tree", "vector"]).select(F.xxhash64("tree", "centre").alias("meeting"), "key").distinct()
    member = stored(different(member).join(distinct.select(key, "sid", "n", "long"), "key").drop("key"), "members")

    found, named, tested = None, None, None
    for forest in [True] * FOREST_ROUNDS + [False]:
        if named is None:
            rooted = member.withColumn("root", F.col("sid"))
        else:  # a pair still apart was a pair of the round before, whose forests name each set that had one
            rooted = member.join(apart, "sid", "left_semi").join(named, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        pairs = candidates(rooted, forest, classes)
        if pairs.isEmpty():  # no two sets that meet and pass the bound are apart any more
            break
        apart = _ends(pairs)
        if tested is not None:
            pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "new-candidates")
            if pairs.isEmpty():
                continue
        tested = pairs if tested is None else tested.union(pairs)
        wanted = distinct.select("sid", "id", "same").join(_ends(pairs), "sid", "left_semi")
        new = links(pairs, _sets_of(docs, wanted, id_col, text_col, words), classes)
        found = new if found is None else found.union(new)
        named = roots(found).select(F.col("node").alias("sid"), "root")
    if named is None:
        named = distinct.select("sid", F.col("sid").alias("root")).limit(0)

    least = of_docs.where("n > 0").groupBy("sid").agg(F.min("id").alias("least")).join(named, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of_set = least.select("sid", "root").join(ids, "root")
    linked = of_docs.where("n > 0").select("id", "n", "sid").join(of_set, "sid").select("id", F.col("n").alias("n_shingles"), "root", "component_id")
    alone = of_docs.where("n = 0").select("id", F.col("n").alias("n_shingles"), F.lit(None).cast("binary").alias("root"), F.col("id").alias("component_id"))
    return linked.unionByName(alone)


def op12_shingle_join(spark, sf_dir):
    return join(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT k, doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s
  FROM d),
c AS (SELECT s, md5(array_to_string(s, chr(10))) AS h, min(doc_id) AS least FROM s WHERE len(s) > 0 GROUP BY s),
x AS (SELECT h, len(s) AS n, unnest(s) AS g FROM c),
pairs AS (
  SELECT a.h AS a, b.h AS b, a.n AS na, b.n AS nb, count(*) AS i FROM x a JOIN x b ON a.g = b.g AND a.h <> b.h
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * i >= 90 * (na + nb - i)),
reach AS (SELECT h AS a, h AS b FROM c UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
roots AS (SELECT reach.a AS h, min(least) AS component_id FROM reach JOIN c ON c.h = reach.b GROUP BY reach.a)
SELECT doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CASE WHEN len(s.s) = 0 THEN doc_id ELSE component_id END AS component_id
FROM s LEFT JOIN roots ON roots.h = md5(array_to_string(s.s, chr(10))) AND len(s.s) > 0
"""
