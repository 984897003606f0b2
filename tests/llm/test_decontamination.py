import hashlib
import re

import pytest
from rows import LONG, SF, documents, values

from oracle_check import compare, connect
from tillworks.llm import decontamination as D


def brute(docs, items, length=10):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            v = words(t)
            for k in range(max(1, len(v) - length + 1) if v else 0):
                run = v[k : k + length]
                for p in range(len(w) - len(run) + 1):
                    if w[p : p + len(run)] == run:
                        hit |= set(range(p, p + len(run)))
                        ids |= {str(item)} - {"None"}
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "QUICK brown fox jumps over the lazy dog and runs far"), (2, "word"), (10, "casa blanca"), (3, None), (4, "  "),
    (None, "alpha beta"), (5, "lambda mu alpha"), (6, "ßtraße naïve"), (2, "word"),
]
COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_odd_rows(spark):
    docs = documents(spark)
    got = values(D.contamination(docs, items(spark)), *COLUMNS)
    assert got == brute([(r[0], r[1]) for r in docs.collect()], ITEMS)


def test_many_segments_and_rounds(spark, monkeypatch):
    docs = documents(spark)
    want = values(D.find(D.build_index(docs), items(spark)), "doc_id", "n_words", "hits", "items")
    monkeypatch.setattr(D, "ROUND_ITEMS", 2)
    got = values(D.find(D.build_index(docs, segment_words=20), items(spark)), "doc_id", "n_words", "hits", "items")
    assert got == want


def test_items_without_an_id_are_searched(spark):
    docs = spark.createDataFrame([(1, "one alpha two"), (2, "beta"), (3, None)], "doc_id bigint, text string")
    asked = spark.createDataFrame([(None, "alpha"), (7, "beta"), (None, "beta")], "item_id bigint, text string")
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in D.contamination(docs, asked).collect()}
    assert got == {1: (1, 0, True), 2: (1, 1, True), 3: (0, 0, False)}


def test_segments_of_documents_without_words(spark):
    docs = spark.range(0, 100, 1, 1).selectExpr("id as doc_id", "if(id % 2 = 0, '', null) as text")
    index = D.build_index(docs, segment_words=20)
    assert max(len(r["docs"]) for r in index.where("term = ''").collect()) == 20
    assert D.find(index, items(spark)).count() == 100


def test_near(spark):
    docs = documents(spark)
    near = D.find(D.build_index(docs), spark.createDataFrame([(1, "dog fox lazy"), (2, "here dog quick")], "item_id bigint, text string"), span=8)
    hits = {r["doc_id"]: (r["hits"], r["items"]) for r in near.collect()}
    assert [tuple(h) for h in hits[1][0]] == [(3, 9)] and hits[1][1] == ["1"] and hits[5] == ([], [])


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert D.contamination(none, items(spark)).count() == 0
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in D.contamination(documents(spark), nothing).collect()} == {0}


def test_sql(spark):
    assert compare(D.op1_decontamination(spark, SF), connect(SF), D.SQL) is None
    assert len(D.words(LONG)) == 36000


@pytest.mark.parametrize("text", ["", "a", "a b a b a b a b a b a b"])
def test_windows(text):
    found = D.words(text)
    assert len(D.item_windows(found, 10)) == (0 if not found else max(1, len(found) - 9))
