"""Operator 10, language identification by cross-parsing against suffix automata.

For each language a bounded sample of labelled text is turned into a suffix automaton. A text is parsed into the
longest phrases that occur in the sample; the fewer phrases, weighted by the bits that name a place in the sample,
the nearer the language: phrases * log2(sample length) / text length estimates the cross entropy, and the least
wins (ties: the first name). Letters are lower-cased, all else between them counts as one space. The most frequent
letters of the samples are symbols of their own, every other letter is spelled by three or four digits of its code
point, so none is lost, whatever the script. Texts are parsed in stretches of ``STRETCH`` symbols, side by side, over
dense transition tables.

The sample is the only bounded part: ``SAMPLE_DOCS`` documents a language, by a hash of their id, the first
``SAMPLE_CHARS`` characters of each, ``SAMPLE_ROWS`` documents and ``SAMPLE_SYMBOLS`` symbols in all. Every label is
learned; the more there are, the smaller the even share of each. Predictions read whole texts.

Defined results: a null text and one without letters are ``und`` with score 0, and so is every text if nothing
could be learned; the score is the share of the runner-up's cost in its and the winner's cost (1 if there is one
label only); rows without id or label are not learned from, and are not held out without an id; repeated rows are
rows like any other; an empty table gives an empty result. Only id, text and label are read, the label for the
sample alone.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks.llm.common import in_batches, resident, table

SAMPLE_DOCS = 96
SAMPLE_CHARS = 1000
SAMPLE_SYMBOLS = 240_000
SAMPLE_ROWS = 64 * SAMPLE_DOCS
STRETCH = 256
UNKNOWN = "und"
_SYMBOLS = 80  # letters with a symbol of their own, the most frequent of the samples
_BASE = 41  # of the digits that spell the others: three up to U+FFFF, four beyond
_SEED = 7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame) -> tuple[tuple[str, str], ...]:
    """(label, text) of each language, bounded as documented above."""
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64(F.lit(_SEED), "doc_id"), "doc_id")
    labels = rows.select("lang").distinct().count()
    if not labels:
        return ()
    each = max(1, min(SAMPLE_DOCS, SAMPLE_ROWS // labels))
    picked = rows.select(
        "lang", "doc_id", F.substring("text", 1, SAMPLE_CHARS).alias("t"), F.row_number().over(by_hash).alias("k")).where(F.col("k") <= each)
    texts: dict[str, list[str]] = {}
    for lang, text in picked.orderBy("lang", "k").select("lang", "t").collect():  # bounded by the sample
        texts.setdefault(lang, []).append(text)
    return tuple((lang, "\n".join(texts[lang])) for lang in sorted(texts))


def _automaton(symbols: list[int], size: int) -> np.ndarray:
    """Dense transitions of the suffix automaton, -1 where there is none; rows lie flat in one array."""
    row = array("i", [-1]) * size
    step, link, length, last = row[:], [-1], [0], 0
    for c in symbols:
        new = len(link)
        step.extend(row)
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and step[p * size + c] < 0:
            step[p * size + c] = new
            p = link[p]
        if p >= 0:
            q = step[p * size + c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                step.extend(step[q * size : (q + 1) * size])
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p * size + c] == q:
                    step[p * size + c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return np.frombuffer(step, np.int32).reshape(-1, size)


class Model:
    """Automata of the sample's languages over one alphabet: 0 space, then letters, then digits of other letters, then padding."""

    def __init__(self, labelled: tuple[tuple[str, str], ...]):
        self.labels = [lang for lang, _ in labelled]
        lower = [text.lower() for _, text in labelled]
        letters = [c for c, _ in Counter(c for t in lower for c in t if c.isalpha()).most_common(_SYMBOLS)]
        self.digits = len(letters) + 1
        self.size = self.digits + _BASE + 1
        self.low = np.arange(0x110000, dtype=np.int32)  # a letter's small form, if that is one letter
        lut = np.zeros(0x110000, np.uint8)
        for i in range(0x110000):
            if (c := chr(i)).isalpha():
                lut[i] = self.digits
                if len(small := c.lower()) == 1:
                    self.low[i] = ord(small)
        for k, c in enumerate(letters, 1):
            lut[ord(c)] = k
        self.lut = lut
        self.tables, self.unseen, self.bits = [], [], []
        share = max(1, SAMPLE_SYMBOLS // max(1, len(labelled)))
        for text in lower:
            symbols = self.symbols(text)[:share]
            step = _automaton(symbols.tolist(), self.size)
            start = np.maximum(step[0], 0)  # a phrase that ends restarts with the letter that ended it
            table = np.where(step >= 0, step, 0) * self.size
            table = np.where(step >= 0, table, ~(start * self.size)[None, :])
            table[0] = start * self.size  # at the start nothing ends; a letter unknown to the sample leaves no phrase open
            table[:, self.size - 1] = np.arange(len(step)) * self.size  # padding stays where it is
            self.tables.append(np.ascontiguousarray(table.ravel(), np.int32))
            unseen = step[0] < 0  # each such letter is a phrase of its own
            unseen[self.size - 1] = False
            self.unseen.append(unseen)
            self.bits.append(math.log2(max(2, len(symbols))))

    def symbols(self, text: str) -> np.ndarray:
        points = self.low.take(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
        found = self.lut.take(points)
        keep = found != 0
        keep[1:] |= found[:-1] != 0
        found = found[keep]
        spelled = np.flatnonzero(found == self.digits)
        if not len(spelled):
            return found
        points = points[keep][spelled]
        width = np.where(points < _BASE**3, 3, 4)
        sizes = np.ones(len(found), np.int64)
        sizes[spelled] = width
        out = np.repeat(found, sizes)
        last = np.cumsum(sizes)[spelled] - 1
        for k in range(4):
            there = width > k
            out[last[there] - k] = self.digits + points[there] // _BASE**k % _BASE
        return out

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each (not empty) text in each language."""
        lanes = np.array([-(-len(t) // STRETCH) for t in texts])
        flat = np.full(int(lanes.sum()) * STRETCH, self.size - 1, np.uint8)
        first = np.concatenate([[0], np.cumsum(lanes)])[:-1]
        for t, k in zip(texts, first.tolist()):
            flat[k * STRETCH : k * STRETCH + len(t)] = t
        steps = np.ascontiguousarray(flat.reshape(-1, STRETCH).T)
        out = np.zeros((len(texts), len(self.tables)), np.int64)
        for k, table in enumerate(self.tables):
            at, ended = np.zeros(steps.shape[1], np.int32), np.zeros(steps.shape[1], np.int32)
            for symbols in steps:
                to = table.take(at + symbols)
                sign = to >> 31  # -1 where the phrase ended
                ended -= sign
                at = to ^ sign
            alone = np.flatnonzero(self.unseen[k])
            if len(alone):
                ended += np.isin(steps, alone).sum(axis=0, dtype=np.int32)
            out[:, k] = np.add.reduceat(ended + (at > 0), first)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        symbols = [self.symbols(t) if t else np.zeros(0, np.uint8) for t in texts]
        rows = [i for i, s in enumerate(symbols) if s.any()]
        if not rows or not self.tables:
            return labels, scores
        cost = self.phrases([symbols[i] for i in rows]) * np.array(self.bits)
        best = cost.argmin(axis=1)
        two = np.sort(cost, axis=1)[:, :2]
        share = two[:, 1] / two.sum(axis=1) if two.shape[1] > 1 else np.ones(len(rows))
        for i, b, s in zip(rows, best.tolist(), share.tolist()):
            labels[i], scores[i] = self.labels[b], s
        return labels, scores


def model(labelled: tuple[tuple[str, str], ...]) -> Model:
    """One per Python worker."""
    return resident(("language", labelled), lambda: Model(labelled))


def predicted_rows(docs: DataFrame, labelled: tuple[tuple[str, str], ...], names: Sequence[str] = ("__lang_pred", "__score")) -> DataFrame:
    """docs, whole rows, with the language and its score under two new names; only the text column is looked at."""
    place = docs.columns.index("text")

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = model(labelled).predict(batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, *names])

    in_batches(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(of_batch, schema)


def predict(docs: DataFrame, labelled: tuple[tuple[str, str], ...]) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of docs."""
    found = predicted_rows(docs.select("doc_id", "text"), labelled)
    return found.select("doc_id", F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"))


def identify(docs: DataFrame) -> DataFrame:
    """Learned from the rows that are not held out: doc_id, held_out, lang_pred, score."""
    return predict(docs, sample(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_language(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))
