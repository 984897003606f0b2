import numpy as np
from rows import SF, values

from oracle_check import compare, connect
from pyspark.sql import functions as F
from tillworks.llm import vector_file as V

SCHEMA = "vec_id bigint, embedding array<float>, ids string, cells int"


def brute(rows, k):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked, out = {}, []
    for i, v in ok:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    for i, q in asked.items():
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def search(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA)
    v = df.where(V.usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(F.col("vec_id").alias("id"), V.scaled(F.col("embedding")).alias("v"))
    return values(V.VectorFile.build(v).search(v.where("id % 50 = 0"), k), "query_id", "rank", "vec_id", "score")


def test_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)]  # many ties
    rows += [(50, rows[50][1]), (7, rows[7][1]), (2000, None), (2050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2100, [float("nan")] * 6),
             (2150, [float("inf")] * 6), (None, [1.0] * 6), (2200, [0.5, 0.25]), (2201, [0.5, -0.25]), (2250, []), (2300, [1e6] * 6), (2301, [-1e6] * 6)]
    want = brute(rows, 5)
    assert search(spark, rows) == want
    monkeypatch.setattr(V, "BLOCK_VALUES", 60)
    monkeypatch.setattr(V, "ROUND_QUERIES", 3)
    assert search(spark, rows) == want


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [1.0]), (1, [2.0])]
    assert search(spark, rows) == [(0, 1, 1, 256 * 512)]
    assert search(spark, []) == []


def test_sql(spark):
    assert compare(V.op2_vector_file(spark, SF), connect(SF), V.SQL) is None
