import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from oracle_check import compare, connect
from rows import SF, documents, values

from tillworks.llm import divergence as D

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def brute(rows, least, top=50):
    """rows: (lang, source, text)."""
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang].add(source)
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= least]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(sum((n[lang, s] for s in sources), Counter()))
        p = {s: shares(n[lang, s]) for s in sources}
        for s in sources:
            far = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources - {s})
            out += [(lang, s, "pair", o.decode(), -v, r) for r, (v, o) in enumerate(far, 1)]
            mine = sorted((q[t] - p[s][t], t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -v, r) for r, (v, t) in enumerate(mine[:top], 1)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(11)
    terms = ["été", "Ωmega", "ab", "AB", "zz"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(9)]
    weights = 1 / np.arange(1, len(terms) + 1)
    rows = [(f"l{i % 3}" if i % 3 else None, f"s{rng.integers(7)}" if i % 5 else None, " ,-1".join(rng.choice(terms, 40, p=weights / weights.sum())))
            for i in range(400)]
    rows += [("l1", "silent", None), ("l1", "silent", ""), ("new", "a", "only here"), ("new", "b", None), ("new", None, "once"), ("lone", "x", "word " * 40)]
    return rows + rows[:20]


@pytest.mark.parametrize("least,block,chunk,top", [(30, 1 << 16, 16, 50), (3, 16, 2, 5), (1, 7, 1, 50)])
def test_against_brute_force(spark, texts, least, block, chunk, top):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in texts], "lang string, source string, text string, n int, block string, place int")
    columns = D.RunColumns.build(df, least, block)
    pairs = values(columns.pairs(chunk), "lang", "source", "item", "value")
    terms = values(columns.marked_terms(top), "lang", "source", "item", "value", "rank")
    want = brute(texts, least, top)
    assert pairs == sorted(((r[0], r[1], r[3], r[4]) for r in want if r[2] == "pair"), key=repr)
    assert terms == sorted(((r[0], r[1], *r[3:]) for r in want if r[2] == "term"), key=repr)


def test_odd_rows_and_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(D, "HELD_TERMS", 3)
    monkeypatch.setattr(D, "_SLICE", 50)
    docs = documents(spark)
    rows = [(r["lang"], r["source"], r["text"]) for r in docs.collect()]
    assert values(D.audit(docs, 1), *COLUMNS) == brute(rows, 1)
    assert values(D.audit(docs), *COLUMNS) == brute(rows, 30)


def test_counts_beyond_a_double(spark):
    """Shares stay exact where SCALE times a count leaves 64 bits."""
    rows = spark.createDataFrame(
        [("l", 0, 0, 2, 1, 3 * 10**12 + 1, 2, [0, 1], [10**12, 2 * 10**12 + 1])],
        "lang string, block bigint, first bigint, size bigint, column int, total bigint, terms bigint, places array<bigint>, n array<bigint>")
    got = rows.mapInArrow(D._encode, "lang string, block bigint, first bigint, size bigint, column int, starts array<int>, counts array<bigint>, shares array<bigint>").first()
    below = 3 * 10**12 + 1 + 10
    assert got["shares"] == [1 + 10**9 * (c + 5) // below for c in (10**12, 2 * 10**12 + 1)]


def test_merged_runs():
    start, length, i, j = D.merge(np.array([0, 3]), np.array([0, 2, 3]), 5)
    assert (start.tolist(), length.tolist(), i.tolist(), j.tolist()) == ([0, 2, 3], [2, 1, 2], [0, 0, 1], [0, 1, 2])


def test_order_makes_few_runs(spark, texts):
    """Equal counts lie together: fewer runs than in the order of the terms."""
    df = spark.createDataFrame(texts, "lang string, source string, text string")
    columns = D.RunColumns.build(df, 3)
    runs = sum(len(r["starts"]) for r in columns.runs.collect())
    unsorted = 0
    counts = {(r["lang"], r["source"], r["term"]): r["n"] for r in D.term_counts(df).collect()}
    terms = defaultdict(list)
    for r in sorted(columns.vocabulary.collect(), key=lambda r: r["term"]):
        terms[r["lang"]].append(r["term"])
    for g in columns.groups.collect():
        column = [counts.get((g["lang"], g["source"], t), 0) for t in terms[g["lang"]]]
        unsorted += sum(a != b for a, b in zip([None, *column], column))
    assert runs < 0.9 * unsorted


def test_empty(spark):
    none = spark.createDataFrame([], "lang string, source string, text string")
    assert D.audit(none).count() == 0


def test_sql(spark):
    assert compare(D.op13_divergence(spark, SF), connect(SF), D.SQL) is None
