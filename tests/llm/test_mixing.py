import re

import pytest
from rows import SF, documents, values
from pyspark.sql import functions as F

from tillworks.llm import mixing as M
from tillworks.llm.common import table


def check(rows, got, slack):
    """rows: (doc_id, source, text); got: doc_id, size, source_size, target, taken."""
    words = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, s, t in rows]
    sizes = {}
    for _, s, n in words:
        sizes[s] = sizes.get(s, 0) + n
    due = M.targets(sizes)
    assert sorted(((d, n, sizes[s], round(due[s], 6)) for d, s, n in words), key=repr) == sorted(((g[0], g[1], g[2], round(g[3], 6)) for g in got), key=repr)
    assert all(g[4] <= 2 * g[1] and (g[1] == 0 or g[4] % g[1] == 0) for g in got)
    taken = {}
    for g in got:
        taken[g[2], round(g[3], 6)] = taken.get((g[2], round(g[3], 6)), 0) + g[4]
    most = {s: max(n for _, x, n in words if x == s) for s in sizes}
    for s in sizes:
        assert abs(taken[sizes[s], round(due[s], 6)] - due[s]) <= slack * most[s] + 1e-6


def test_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "source", "text").collect()]
    columns = ("doc_id", "size", "source_size", "target", "taken")
    got = values(M.op9_mixing(spark, SF), *columns)
    check(rows, got, 0.5)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    assert got == values(M.op9_mixing(spark, SF), *columns)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_odd_rows(spark):
    docs = documents(spark)
    found = M.copies(docs).withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).withColumn("taken", F.col("size") * F.col("copies"))
    got = [tuple(r) for r in found.select("doc_id", "size", "source_size", "target", "taken").collect()]
    check([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()], got, 2)
    assert M.copies(docs.where("doc_id > 99")).count() == 0


def test_targets():
    due = M.targets({"a": 100, "b": 1000, None: 10, "c": 0})
    assert due["a"] == 200 and due["c"] == 0 and due[None] == 20 and due["b"] == pytest.approx(1110 * 1.5 - 220)
    assert M.targets({}) == {} and M.targets({"a": 0}) == {"a": 0.0}
    equal = M.targets({"a": 60, "b": 60, "c": 60})
    assert equal == {"a": 120.0, "b": 50.0, "c": 100.0}


def test_expected_copies(spark):
    """Many equal documents: their share of copies is the ratio, exact in sum."""
    docs = documents(spark, [(i, "a b c d e f g h i j", "en", "ab"[i % 3 == 0]) for i in range(900)])
    rows = M.copies(docs).collect()
    for source in "ab":
        mine = [r for r in rows if r["source"] == source]
        assert sum(r["copies"] * r["size"] for r in mine) == pytest.approx(mine[0]["target"], abs=5)
        assert {r["copies"] for r in mine} <= {0, 1, 2}


@pytest.mark.parametrize("long, short, n", [(20_000, 150, 500), (50_000, 60, 3000)])
def test_one_long_document(spark, long, short, n):
    """What a long document misses is made up by the short ones of its source."""
    texts = [("w " * long, "a")] + [("w " * (short - 40 + i * 37 % 81), "a") for i in range(n)] + [("w " * 500, "b")] * 90
    docs = documents(spark, [(i, t, "en", s) for i, (t, s) in enumerate(texts)])
    rows = [r for r in M.copies(docs, share=0.5).collect() if r["source"] == "a"]
    assert abs(sum(r["copies"] * r["size"] for r in rows) - rows[0]["target"]) <= short


def test_passes():
    assert M._passes({5: 3000.0, 6: 40000.0, 7: 30000.0, 14: 20000.0}, 0.5) == {5: 0, 6: 1, 7: 1, 14: 1 + 1}
    assert M._passes({3: 80.0}, 0.5) == {3: 0} and M._passes({}, 0.5) == {}
