"""Operator 4, line dedup by content-defined chunks of lines.

Every line is hashed; a polynomial over the hashes of the last ``WINDOW`` lines decides whether a chunk ends after
a line, so boundaries follow the content and fall into step again after lines were put in or taken out. The longer
the window's lines, the likelier is a boundary, certain from ``SPAN`` characters on: a passage worth removing has one
whether it is two long lines or ten short ones. A text's end is a boundary, too. A chunk is known by the window at its
end, which lies in it whatever stands before. Windows meet by their hash, of which only ids and places are shuffled;
where a hash repeats, bytes are compared, and from a repeated window the chunk grows line by line, back and ahead,
while its lines equal those of the first copy (least id, then place), up to the windows of the neighbouring chunks,
which speak for themselves. The first copy stays, the others lose those lines. So every removed line equals an
earlier one that stays; a line repeated on end shrinks to one.

Defined results: a null text stays null and has no lines; an empty text is one empty line; rows with equal id and
text are one document, kept and cut alike; null ids come first; windows of empty lines only are no boundaries; texts
of fewer than ``WINDOW`` lines stay; an empty table gives an empty result. Columns of the input other than id and text
are passed through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillworks.llm.common import fresh_names, stored, table

WINDOW = 2  # lines, the least that is removed
SPAN = 240  # characters of a window that make a boundary certain

_P = 2_147_483_647


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _windows(text: Column, window: int, span: int) -> Column:
    """Array of (start, low, high): first line of each boundary's window, and the lines [low, high) it may grow to."""
    return _bound(F.split(text, "\n", -1), lambda lines: _bound(
        F.transform(lines, lambda x: F.struct(
            F.conv(F.substring(F.md5(x), 1, 7), 16, 10).cast("bigint").alias("h"), F.length(x).alias("n"))),
        lambda hs: _bound(_ends(hs, window, span), lambda ends: F.transform(ends, lambda e, k: F.struct(
            (e - window + 1).alias("start"),
            F.when(k == 0, 0).otherwise(F.get(ends, k - 1) - window + 2).alias("low"),
            F.coalesce(F.get(ends, k + 1), F.size(hs)).alias("high"))))))


def _ends(hs: Column, window: int, span: int) -> Column:
    """Last lines of the windows that are boundaries."""
    def chosen(e: Column) -> Column:
        part = F.slice(hs, e - window + 2, F.lit(window))
        rolled = F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: (a * 31 + x["h"]) % _P)
        chars = F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
        return (rolled % span < chars) | ((e == F.size(hs) - 1) & (chars > 0))

    places = F.when(F.size(hs) >= window, F.sequence(F.lit(window - 1), F.size(hs) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, chosen)


def _equal_lines(a: Column, b: Column) -> Column:
    """How many of two arrays' first lines are the same."""
    equal = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    return F.coalesce(F.nullif(F.array_position(equal, False), F.lit(0)) - 1, F.size(equal)).cast("int")


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, span: int = SPAN) -> DataFrame:
    """(id, same, chunks): lines to remove, as disjoint (start, lines), of the documents that have any; same hashes the text."""
    if window < 2:
        raise ValueError("a chunk has two lines or more")
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t is not null")
    keyed = own.select("id", "t", F.xxhash64("t").alias("same"))
    cut = keyed.select("id", "same", F.explode(_bound(F.split("t", "\n", -1), lambda lines: F.transform(
        _windows(F.col("t"), window, span), lambda c: F.struct(
            c["start"].alias("start"), c["low"].alias("low"), c["high"].alias("high"),
            F.xxhash64(F.array_join(F.slice(lines, c["start"] + 1, window), "\n")).alias("h"))))).alias("c"))
    places = stored(cut.select("id", "same", "c.*"), "line-chunks")
    # stored, so that the join has a shuffle of its own on both sides, which AQE can split where a hash is frequent
    repeated = stored(places.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-hashes")
    wanted = stored(places.join(repeated, "h"), "repeated-chunks").groupBy("id", "same").agg(
        F.collect_set(F.struct("start", "low", "high", "h")).alias("cs"))
    # only texts with repeated hashes are read again, and only their repeated windows leave this join
    # by a shuffle at any size: which documents repeat is no small table
    met = keyed.alias("a").join(wanted.hint("merge").alias("w"), F.col("a.id").eqNullSafe(F.col("w.id")) & (F.col("a.same") == F.col("w.same")))
    told = stored(met.select("a.id", "a.same", F.explode(_bound(F.split("t", "\n", -1), lambda lines: F.transform("cs", lambda c: F.struct(
        c["start"].alias("start"), c["h"].alias("h"),
        F.array_join(F.slice(lines, c["start"] + 1, window), "\n").alias("bytes"),
        F.reverse(F.slice(lines, c["low"] + 1, c["start"] - c["low"])).alias("back"),
        F.slice(lines, c["start"] + window + 1, c["high"] - c["start"] - window).alias("ahead"))))).alias("c")).select(
        "id", "same", "c.*").dropDuplicates(["id", "same", "start"]), "chunk-texts")
    first = stored(told.groupBy("h", "bytes").agg(
        F.min(F.struct("id", "same", "start", "back", "ahead")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first-chunks")
    spare = told.alias("t").join(first.alias("f"), ["h", "bytes"]).where(
        ~F.struct("t.id", "t.same", "t.start").eqNullSafe(F.struct("f.first.id", "f.first.same", "f.first.start")))
    grown = spare.select(
        "t.id", "t.same", (F.col("t.start") - _equal_lines(F.col("t.back"), F.col("f.first.back"))).alias("start"),
        (F.col("t.start") + window + _equal_lines(F.col("t.ahead"), F.col("f.first.ahead"))).alias("end"))
    # overlapping and adjoining spans of a document become one
    w = Window.partitionBy("id", "same").orderBy("start", "end")
    fresh = grown.withColumn("new", F.coalesce(F.col("start") > F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True)).cast("int"))
    runs = fresh.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).groupBy("id", "same", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("id", "same").agg(F.sort_array(F.collect_list(F.struct("start", (F.col("end") - F.col("start")).alias("lines")))).alias("chunks"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """docs with the repeated chunks taken out of the text, and columns n_lines, n_removed, removed (start, lines).

    Added columns that the input has already get underscores in front.
    """
    n_lines, n_removed, removed, id_, same, cut = fresh_names(
        docs.columns, "n_lines", "n_removed", "removed", "__id", "__same", "__cut")
    spare = stored(removals(docs, id_col, text_col, **how), "spare-chunks").select(
        F.col("id").alias(id_), F.col("same").alias(same), F.col("chunks").alias(cut))
    text, cuts = F.col(f"`{text_col}`"), F.col(f"`{cut}`")
    joined = docs.join(spare.hint("merge"), F.col(f"`{id_col}`").eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(same)), "left")
    lines = F.split(text, "\n", -1)

    def between(ls: Column) -> Column:
        """The lines before, between and after the cuts."""
        def part(k: Column) -> Column:
            before = F.get(cuts, k - 1)
            low = F.when(k == 0, 0).otherwise(before["start"] + before["lines"])
            return F.slice(ls, low + 1, F.coalesce(F.get(cuts, k)["start"], F.size(ls)) - low)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cuts)), part))

    kept = F.array_join(_bound(lines, between), "\n")
    gone = F.aggregate(cuts, F.lit(0).cast("bigint"), lambda a, c: a + c["lines"])
    return joined.select(
        *[F.when(cuts.isNull(), text).otherwise(kept).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias(n_lines),
        F.coalesce(gone, F.lit(0)).cast("bigint").alias(n_removed),
        F.coalesce(F.expr(f"transform(`{cut}`, c -> named_struct('start', cast(c.start as bigint), 'lines', cast(c.lines as bigint)))"), F.expr("cast(array() as array<struct<start:bigint,lines:bigint>>)")).alias(removed))


def op4_line_chunks(spark, sf_dir):
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.to_json("removed").alias("removed"), "text")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS l FROM documents),
e AS (
  SELECT *, list_transform(l, lambda x: CAST('0x' || substr(md5(x), 1, 7) AS BIGINT)) AS h FROM d WHERE len(l) >= {WINDOW}),
s AS (
  SELECT *, list_filter(range(1, len(l)), lambda i: (h[i] * 31 + h[i + 1]) % {_P} % {SPAN} < length(l[i]) + length(l[i + 1])
    OR (i = len(l) - 1 AND length(l[i]) + length(l[i + 1]) > 0)) AS ends FROM e),
c AS (
  SELECT rid, doc_id, text, l, ends[k] - 1 AS start, CASE WHEN k = 1 THEN 0 ELSE ends[k - 1] END AS low, coalesce(ends[k + 1], len(l)) AS high
  FROM (SELECT *, unnest(range(1, len(ends) + 1)) AS k FROM s)),
t AS (
  SELECT rid, doc_id, text, start, l[start + 1] || chr(10) || l[start + 2] AS bytes,
         list_reverse(l[low + 1:start]) AS back, l[start + 3:high] AS ahead FROM c),
f AS (
  SELECT *, first_value(rid) OVER w AS first_rid, first_value(start) OVER w AS first_start, first_value(text) OVER w AS first_text,
         first_value(back) OVER w AS first_back, first_value(ahead) OVER w AS first_ahead
  FROM t WINDOW w AS (PARTITION BY bytes ORDER BY doc_id NULLS FIRST, rid, start)),
z AS (
  SELECT *, list_transform(list_zip(back, first_back), lambda x: x[1] IS NOT DISTINCT FROM x[2]) AS eb,
         list_transform(list_zip(ahead, first_ahead), lambda x: x[1] IS NOT DISTINCT FROM x[2]) AS ea
  FROM f WHERE rid <> first_rid OR start <> first_start),
x AS (
  SELECT DISTINCT rid, unnest(range(start - (coalesce(nullif(list_position(eb, false), 0) - 1, len(eb))),
         start + 2 + (coalesce(nullif(list_position(ea, false), 0) - 1, len(ea))))) AS line FROM z),
y AS (SELECT rid, min(line) AS start, count(*) AS lines FROM (
  SELECT *, line - row_number() OVER (PARTITION BY rid ORDER BY line) AS run FROM x) GROUP BY rid, run),
g AS (
  SELECT rid, sum(lines) AS n_removed, '[' || string_agg('{{"start":' || start || ',"lines":' || lines || '}}', ',' ORDER BY start) || ']' AS removed
  FROM y GROUP BY rid),
k AS (
  SELECT rid, string_agg(line, chr(10) ORDER BY i) AS text FROM (
    SELECT d.rid, unnest(l) AS line, unnest(range(len(l))) AS i FROM d JOIN g USING (rid)) u
  ANTI JOIN x ON x.rid = u.rid AND x.line = u.i GROUP BY rid)
SELECT d.doc_id, coalesce(len(d.l), 0) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed, '[]') AS removed,
       CASE WHEN g.rid IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text
FROM d LEFT JOIN g USING (rid) LEFT JOIN k USING (rid)
"""
