"""Operator 13, source divergence audit: how far the word shares of a language's sources lie apart.

Each language keeps the terms that stand in at least ``LEAST_DOCS`` of its documents. Per language the kept terms
are put in an order in which equal counts lie side by side: lexicographic in the counts of its sources, sources of
few words first, since their columns hold the fewest different values. Each source's counts in that order are a
column, cut into blocks of ``BLOCK_TERMS`` terms and run-length encoded; the language as a whole has one more.
Two columns are compared run by run: their boundaries are merged, and the difference f of the two smoothed shares
is taken once per merged run and multiplied by its length. Blocks and chunks of ``CHUNK`` columns bound a task;
only sums leave it.

Shares are integers, ``p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``, computed without rounding at
any size of the counts.

Defined results: null lang, source and text read as ''; a (lang, source) group without terms, or without any text,
takes part with counts of zero; a language that keeps no term has pairs of value 0 and no term rows; repeated rows
count each; ties go to the item that is less in UTF-8; an empty table gives an empty result. Only the three columns
are read, so further columns may have any name. A document of any length is cut at separators while it is counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import in_batches, stored, table, vacate
from tillworks.operators.ranking import with_position

LEAST_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP_TERMS = 50
BLOCK_TERMS = 1 << 16
CHUNK = 16  # columns; a task compares two chunks of one block
HELD_TERMS = 1 << 18  # different terms that a task counts before it hands them on
SORT_COLUMNS = 64  # leading non-zero counts of a term that its place depends on
_SLICE = 1 << 20

# letters of either case become lower case, all other ASCII characters separate
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + _SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of each group's terms, and a row with a null term for each group."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vacate()
        held: dict[tuple[bytes, bytes], tuple[Counter, Counter]] = {}

        def hand_on() -> pa.RecordBatch:
            rows: list[list] = [[], [], [], [], []]
            for (lang, source), (n, documents) in held.items():
                terms = [None, *n]
                for column, values in zip(rows, (
                        [lang] * len(terms), [source] * len(terms), terms, [0, *n.values()], [0, *map(documents.__getitem__, n)])):
                    column.extend(values)
            held.clear()
            kinds = (pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                n, documents = held.setdefault((lang, source), (Counter(), Counter()))
                mine: set[bytes] = set()
                for some in words(text):
                    n.update(some)
                    mine.update(some)
                documents.update(mine)
            if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                yield hand_on()
        yield hand_on()

    in_batches(docs.sparkSession)
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c) for c in ("lang", "source", "text")])
    parts = read.mapInArrow(of_task, "lang binary, source binary, term binary, n bigint, docs bigint")
    named = parts.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "term")], "n", "docs")
    return named.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class RunColumns:
    """Run-length columns of all groups: what is kept, in which order, and the encoded counts."""

    def __init__(self, groups: DataFrame, vocabulary: DataFrame, runs: DataFrame):
        self.groups = groups  # lang, source, column (from 1 in each lang), total, terms
        self.vocabulary = vocabulary  # lang, term, place
        self.runs = runs  # lang, block, first, size, column (0: the lang), starts, counts, shares

    @classmethod
    def build(cls, docs: DataFrame, least_docs: int = LEAST_DOCS, block_terms: int = BLOCK_TERMS) -> RunColumns:
        counts = stored(term_counts(docs), "term-counts")
        terms = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        kept = stored(terms.where(F.col("docs") >= least_docs).select("lang", "term", "n"), "kept-terms")
        cells = counts.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n")
        of_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count("*").alias("terms"))
        of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = counts.where("term IS NULL").select("lang", "source").join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
        groups = groups.fillna(0, ["total", "lang_total", "terms"])
        few_first = Window.partitionBy("lang").orderBy("total", "source")  # a row per source
        groups = stored(groups.withColumn("column", F.row_number().over(few_first)), "groups")

        cells = stored(cells.join(groups.select("lang", "source", "column"), ["lang", "source"]).select("lang", "term", "column", "n"), "cells")
        # the greater of two sparse lists of (-column, count) is the greater of the two rows of counts
        row = F.sort_array(F.collect_list(F.struct((-F.col("column")).alias("c"), "n")), asc=False)
        order = cells.groupBy("lang", "term").agg(F.slice(row, 1, SORT_COLUMNS).alias("row"))
        vocabulary = with_position(order, ["lang", F.desc("row"), "term"], "place", start=0).select("lang", "term", "place")
        block = F.floor(F.col("place") / block_terms)
        vocabulary = stored(vocabulary.withColumn("block", block), "vocabulary")

        all_columns = cells.unionByName(kept.select("lang", "term", F.lit(0).alias("column"), "n"))
        entry = F.sort_array(F.collect_list(F.struct("place", "n")))
        entries = all_columns.join(vocabulary, ["lang", "term"]).groupBy("lang", "block", "column").agg(entry.alias("e"))
        blocks = vocabulary.groupBy("lang", "block").agg(F.min("place").alias("first"), F.count("*").alias("size"))
        wanted = groups.select("lang", "column", "total", "terms").unionByName(
            groups.select("lang", F.lit(0).alias("column"), F.col("lang_total").alias("total"), "terms").distinct())
        wanted = wanted.join(blocks, "lang", "left").fillna(0, ["block", "first", "size"])
        dense = wanted.join(entries, ["lang", "block", "column"], "left").select(
            "lang", "block", "first", "size", "column", "total", "terms",
            F.coalesce("e.place", F.array().cast("array<bigint>")).alias("places"), F.coalesce("e.n", F.array().cast("array<bigint>")).alias("n"))
        runs = dense.mapInArrow(_encode, "lang string, block bigint, first bigint, size bigint, column int, starts array<int>, counts array<bigint>, shares array<bigint>")
        return cls(groups, vocabulary, stored(runs, "run-length-columns"))

    def pairs(self, chunk: int = CHUNK) -> DataFrame:
        """(lang, source, item, value) for all ordered pairs of different sources of a language."""
        mine = F.floor((F.col("column") - 1) / chunk).cast("int")
        chunks = self.groups.groupBy("lang").agg(F.floor((F.max("column") - 1) / chunk).cast("int").alias("last"))
        dealt = self.runs.where("column > 0").join(chunks, "lang").select(
            "lang", "block", "size", "column", "starts", "shares", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other"))
        met = dealt.groupBy("lang", "block", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"))

        def compare(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            lang, _, lo, hi = (k.as_py() for k in key)
            columns = list(_columns(rows, "mine", "column", "size", "starts", "shares"))
            left = [c for c in columns if c[0] == lo]
            right = [c for c in columns if c[0] == hi]
            out: list[tuple[int, int, int]] = []
            for _, a, size, starts, shares in left:
                for _, b, _, others, theirs in right:
                    if a < b or lo < hi:
                        _, length, i, j = merge(starts, others, size)
                        out.append((a, b, int((np.abs(shares[i] - theirs[j]) * length).sum())))
            a, b, value = zip(*out) if out else ((), (), ())
            return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "value": pa.array(value, pa.int64())})

        sums = met.applyInArrow(compare, "lang string, a int, b int, value bigint").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        both = sums.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))).alias("p"))
        x = self.groups.select("lang", F.col("column").alias("x"), "source")
        y = self.groups.select("lang", F.col("column").alias("y"), F.col("source").alias("item"))
        return both.select("lang", "p.*", "value").join(x, ["lang", "x"]).join(y, ["lang", "y"]).select("lang", "source", "item", "value")

    def marked_terms(self, n: int = TOP_TERMS) -> DataFrame:
        """(lang, source, item, value, rank): a source's ``n`` terms whose share exceeds the language's most."""
        whole = self.runs.where("column = 0").select("lang", "block", F.col("starts").alias("all_starts"), F.col("shares").alias("all_shares"))
        beside = self.runs.where("column > 0 AND size > 0").join(whole, ["lang", "block"])

        def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, (lang, column, first, size, starts, counts, shares, others, theirs) in enumerate(
                        _columns(batch, "lang", "column", "first", "size", "starts", "counts", "shares", "all_starts", "all_shares")):
                    start, length, i, j = merge(starts, others, size)
                    f = np.where(counts[i] > 0, shares[i] - theirs[j], 0)
                    at = np.flatnonzero(f > 0)
                    at = at[np.argsort(-f[at], kind="stable")]
                    before = np.cumsum(length[at]) - length[at]
                    above = before[np.searchsorted(-f[at], -f[at], "left")] if len(at) else before  # terms of a greater f
                    at = at[above < n]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(at), pa.string()), pa.array([column] * len(at), pa.int32()), pa.array(first + start[at]),
                         pa.array(length[at]), pa.array(f[at])], names=["lang", "column", "start", "length", "value"])

        found = beside.select("lang", "column", "first", "size", "starts", "counts", "shares", "all_starts", "all_shares").mapInArrow(
            segments, "lang string, column int, start bigint, length bigint, value bigint")
        places = found.select("lang", "column", "value", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("place"))
        named = places.join(self.vocabulary.select("place", F.col("term").alias("item")), "place")
        best = Window.partitionBy("lang", "column").orderBy(F.desc("value"), "item")
        top = named.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
        return top.join(self.groups.select("lang", "column", "source"), ["lang", "column"]).select("lang", "source", "item", "value", "rank")


def _columns(rows: pa.Table | pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows as tuples, lists as numpy arrays."""
    columns = [rows.column(n) for n in names]
    for k in range(rows.num_rows):
        yield tuple(c[k].values.to_numpy(zero_copy_only=False) if pa.types.is_list(c.type) else c[k].as_py() for c in columns)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, block, first, size, column, total, terms, places, n in _columns(
                batch, "lang", "block", "first", "size", "column", "total", "terms", "places", "n"):
            counts = np.zeros(size, np.int64)
            counts[places - first] = n
            starts = np.flatnonzero(np.diff(counts, prepend=counts[0] + 1)) if size else np.zeros(0, np.int64)
            counts = counts[starts]
            shares = [1 + SCALE * (c + PRIOR) // (total + PRIOR * terms) for c in counts.tolist()]  # exact at any size
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang], pa.string()), pa.array([block], pa.int64()), pa.array([first], pa.int64()), pa.array([size], pa.int64()),
                 pa.array([column], pa.int32()), pa.array([starts], pa.list_(pa.int32())), pa.array([counts], pa.list_(pa.int64())),
                 pa.array([shares], pa.list_(pa.int64()))],
                names=["lang", "block", "first", "size", "column", "starts", "counts", "shares"])


def merge(a: np.ndarray, b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the runs between the boundaries of both columns, and the run of each column they lie in."""
    start = np.union1d(a, b).astype(np.int64)
    length = np.diff(np.append(start, size))
    return start, length, np.searchsorted(a, start, "right") - 1, np.searchsorted(b, start, "right") - 1


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: all other sources by divergence, and the terms that mark a source."""
    columns = RunColumns.build(docs, least_docs)
    far_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")  # a row per source of the lang
    pairs = columns.pairs().withColumn("rank", F.row_number().over(far_first))

    def part(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))

    return part(pairs, "pair").unionByName(part(columns.marked_terms(top), "term"))


def op13_divergence(spark, sf_dir):
    return audit(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (
  SELECT *, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5))
    // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM cells),
q AS (
  SELECT *, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5))
    // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM kept),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p > q)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM listed)
WHERE part = 'pair' OR rank <= 50
"""
