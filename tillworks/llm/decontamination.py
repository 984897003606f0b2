"""Operator 1, benchmark decontamination: a positional inverted index over training text.

Documents are cut into segments of about ``SEGMENT_WORDS`` words. For every term of a segment the index
stores one row with the positions of the term; a row with the empty term lists the segment's documents.
Rows never gather a term over all documents, so the most frequent word costs each segment its own share only.
Test phrases are then looked up segment by segment: the rarest term's positions, moved by the term's offset
in the phrase, are intersected with those of the next rarest term until none or all terms are through.

Defined results: a null text has no words; a null id is kept; repeated rows give repeated result rows; items
without words have no windows, those of items without an id count as hits but name no item; empty tables give empty results. Only the id and text columns
of either table are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.common import in_batches, stored, table, vacate

WINDOW = 10
SEGMENT_WORDS = 1 << 20
# Bounds of the test phrases that are sent to every task at once; more are looked up in several rounds.
ROUND_ITEMS = 4096
ROUND_CHARS = 4_000_000

_SEPARATE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and characters beyond ASCII, after A-Z went to lower case; UTF-8."""
    return text.encode().translate(_SEPARATE).split() if text else []


class _Terms(dict):
    """Numbers terms as they first appear."""

    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


def _postings(segment: str, ids: list, sizes: list[int], numbers: list[np.ndarray], terms: _Terms, schema: pa.Schema):
    """Index rows of one segment. A free position after each document keeps phrases inside it."""
    sizes = np.array(sizes, np.int64)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    number = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
    place = np.arange(len(number)) + np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(number, kind="stable")
    counts = np.bincount(number, minlength=len(terms)) if len(terms) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)])
    place = place[order].astype(np.int64)
    steps = np.diff(place, prepend=0)
    steps[ends[:-1]] = place[ends[:-1]]  # each list starts with its first position
    data = pa.py_buffer(steps.astype("<u4").tobytes())
    lists = pa.Array.from_buffers(pa.binary(), len(terms), [None, pa.py_buffer((ends * 4).astype("<i4").tobytes()), data])
    names = pa.array(list(terms), pa.binary()).cast(pa.string())
    head = [[segment], [""], [len(ids)], [base.astype("<u4").tobytes()], [ids]]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(head, schema)], schema=schema)
    yield pa.RecordBatch.from_arrays(
        [pa.array([segment] * len(terms), pa.string()), names, pa.array(counts.astype(np.int32)), lists,
         pa.nulls(len(terms), schema.field("docs").type)], schema=schema)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The positional index of docs as a stored table (segment, term, n, positions, docs).

    positions holds little-endian 32-bit steps from one position of the term to the next. The row of the empty
    term has the documents of its segment in order, and in positions the place where each of them begins.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("segment", T.StringType()), T.StructField("term", T.StringType()),
        T.StructField("n", T.IntegerType()), T.StructField("positions", T.BinaryType()),
        T.StructField("docs", T.ArrayType(id_type)),
    ])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        vacate()
        arrow, part, made = to_arrow_schema(schema), TaskContext.get().partitionId(), 0
        ids, sizes, numbers, terms, held = [], [], [], _Terms(), 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = words(text.as_py())
                ids.append(doc)
                sizes.append(len(found))
                numbers.append(np.fromiter(map(terms.__getitem__, found), np.int32, len(found)))
                held += len(found) + 1  # a segment of documents without words ends, too
                if held >= segment_words:
                    yield from _postings(f"{part}-{made}", ids, sizes, numbers, terms, arrow)
                    ids, sizes, numbers, terms, held, made = [], [], [], _Terms(), 0, made + 1
        if ids:
            yield from _postings(f"{part}-{made}", ids, sizes, numbers, terms, arrow)

    in_batches(docs.sparkSession)
    return stored(docs.select(id_col, text_col).mapInArrow(segments, schema), "postings")


def item_windows(found: list[bytes], length: int) -> list[tuple[bytes, ...]]:
    """All runs of ``length`` words; fewer words are one run, none are none."""
    if not found:
        return []
    return [tuple(found[i : i + length]) for i in range(max(1, len(found) - length + 1))]


def _exact(terms: tuple[bytes, ...], lists: dict[bytes, np.ndarray]) -> list[tuple[int, int]]:
    """Where the phrase stands: lists from the rarest term on, moved by their offsets, intersected."""
    order = sorted(range(len(terms)), key=lambda i: len(lists[terms[i]]))
    at = lists[terms[order[0]]] - order[0]
    for i in order[1:]:
        if not len(at):
            break
        held = lists[terms[i]]
        k = np.minimum(np.searchsorted(held, at + i), len(held) - 1)
        at = at[held[k] == at + i]
    return [(int(p), int(p) + len(terms)) for p in at]


def _near(terms: tuple[bytes, ...], lists: dict[bytes, np.ndarray], base: np.ndarray, span: int) -> list[tuple[int, int]]:
    """Shortest stretches of at most ``span`` words of a document that hold every term, by an occurrence of the rarest."""
    rare, *others = sorted(set(terms), key=lambda t: len(lists[t]))
    at = lists[rare]
    for t in others:
        held = lists[t]
        k = np.searchsorted(held, at - span + 1)
        at = at[(k < len(held)) & (held[np.minimum(k, len(held) - 1)] < at + span)]
    out = set()
    for p in map(int, at):
        doc = np.searchsorted(base, p, "right")
        low, high = max(p - span + 1, int(base[doc - 1])), min(p + span, int(base[doc]) - 1)
        near = sorted([(p, rare)] + [
            (int(q), t) for t in others for q in lists[t][np.searchsorted(lists[t], low) : np.searchsorted(lists[t], high)]])
        count, left, best = {}, 0, None
        for right, (q, t) in enumerate(near):
            count[t] = count.get(t, 0) + 1
            while len(count) == len(others) + 1:
                if best is None or q - near[left][0] < best[1] - best[0] - 1:
                    best = (near[left][0], q + 1)
                gone = near[left][1]
                count[gone] -= 1
                if not count[gone]:
                    del count[gone]
                left += 1
        if best and best[1] - best[0] <= span:
            out.add(best)
    return sorted(out)


def _look_up(index: DataFrame, items: list[tuple], length: int, span: int | None) -> DataFrame:
    """One round: per document the merged word spans and the items that were found."""
    phrases: dict[tuple[bytes, ...], list[str]] = {}  # an item without an id has windows, but no name
    for item, text in items:
        found = words(text)
        runs = item_windows(found, length) if span is None else [tuple(found)] * bool(found)
        for run in set(runs):
            phrases.setdefault(run, []).extend([] if item is None else [str(item)])
    id_type = index.schema["docs"].dataType.elementType
    schema = T.StructType([
        T.StructField("segment", T.StringType()), T.StructField("doc_no", T.IntegerType()),
        T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ])

    def search(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        lists, ids, base = {}, [], np.zeros(1, np.int64)
        for term, positions, docs in zip(*(rows.column(c) for c in ("term", "positions", "docs"))):
            held = np.frombuffer(positions.as_py(), "<u4").astype(np.int64)
            if term.as_py() == "":
                ids, base = docs.as_py(), held
            else:
                lists[term.as_py().encode()] = np.cumsum(held)
        edge = np.zeros(int(base[-1]) + 1, np.int32)
        by_doc: dict[int, set[str]] = {}
        for phrase, names in phrases.items():
            if all(t in lists for t in phrase):
                found = _exact(phrase, lists) if span is None else _near(phrase, lists, base, span)
                for start, end in found:
                    edge[start] += 1
                    edge[end] -= 1
                    by_doc.setdefault(int(np.searchsorted(base, start, "right")) - 1, set()).update(names)
        hit = np.cumsum(edge) > 0
        turns = np.flatnonzero(np.diff(hit, prepend=False))
        spans: dict[int, list[dict]] = {}
        for start, end in zip(turns[::2], turns[1::2]):
            doc = int(np.searchsorted(base, start, "right")) - 1
            spans.setdefault(doc, []).append({"start": int(start - base[doc]), "end": int(end - base[doc])})
        n = len(ids)
        return pa.Table.from_arrays([
            pa.array([key[0].as_py()] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array(ids, rows.schema.field("docs").type.value_type),
            pa.array(np.diff(base) - 1, pa.int64()),
            pa.array([spans.get(i, []) for i in range(n)], to_arrow_schema(schema).field("hits").type),
            pa.array([sorted(by_doc.get(i, ())) for i in range(n)], pa.list_(pa.string())),
        ], schema=to_arrow_schema(schema))

    spark = index.sparkSession
    vocabulary = sorted({t.decode() for run in phrases for t in run})
    wanted = spark.createDataFrame([("",), *((t,) for t in vocabulary)], "term string")  # bounded by ROUND_CHARS
    return index.join(F.broadcast(wanted), "term", "left_semi").groupBy("segment").applyInArrow(search, schema)


def find(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = WINDOW, span: int | None = None) -> DataFrame:
    """Per indexed document (doc_id, n_words, hits, items).

    hits are the merged word spans [start, end) that items cover: exact runs of ``length`` words or, if ``span``
    is given, stretches of at most ``span`` words that hold all different words of an item in any order. items
    are the ids found, as text, sorted. The test items are looked up in rounds of bounded size.
    """
    spark = index.sparkSession
    asked = items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    n, chars = asked.agg(F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    rounds = max(1, -(-n // ROUND_ITEMS), -(-chars // ROUND_CHARS))
    parts = []
    for k in range(rounds):
        mine = asked if rounds == 1 else asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(rounds)) == k)
        parts.append(_look_up(index, [tuple(r) for r in mine.collect()], length, span))
    if rounds == 1:
        return parts[0].select("doc_id", "n_words", "hits", "items")
    spark.conf.set("spark.sql.optimizer.maxIterations", "200")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    joined = whole.groupBy("segment", "doc_no").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.sort_array(F.flatten(F.collect_list("hits"))).alias("h"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = """aggregate(h, cast(array() as array<struct<start:bigint,end:bigint>>), (a, x) ->
        if(size(a) > 0 and element_at(a, -1).end >= x.start,
           concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end)))),
           concat(a, array(x))))"""
    return joined.select("doc_id", "n_words", F.expr(merged).alias("hits"), "items")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find(build_index(docs), items)
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def op1_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
p AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
s AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS run
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
m AS (SELECT s.rid, s.n, s.i, p.item FROM s JOIN p ON s.run = p.run AND s.n = p.n),
h AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM m) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM m WHERE item IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""
