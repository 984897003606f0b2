import numpy as np
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F
from rows import SF, values

from tillworks.llm import hard_negatives as H

SCHEMA = "id bigint, label int, v array<bigint>, block string, d int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, anchors):
    out, first = [], {}
    for i, label, v in anchors:
        first[i] = min(first.get(i, (label, v)), (label, v))
    for i, (label, q) in first.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, other) for j, other, v in rows if j != i and len(v) == len(q))
        for score, j, _ in [s for s in scored if s[2] == label][:5]:
            inside = [(-s, k) for s, k, other in scored if other != label and 80 * -score <= 100 * -s <= 100 * -score][:5]
            out += [(i, j, r, k, -score, s) for r, (s, k) in enumerate(inside, 1)]
    return sorted(out, key=repr)


def mine(spark, rows, anchors):
    frame = [spark.createDataFrame([(*r, "x", 0) for r in part], SCHEMA) for part in (rows, anchors)]
    return values(H.mine(*frame), *COLUMNS)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 6)) * 90
    rows = [(i, int(rng.integers(0, 4)), [int(x) for x in centres[i % 12] + rng.normal(size=6) * 12]) for i in range(500)]
    rows += [(1000 + i, i % 3, rows[100][2]) for i in range(30)]  # many ties
    rows += [(100, 2, rows[100][2]), (100, 0, [1] * 6), (7, 1, rows[7][2]), (2000, 1, []), (2001, 2, []), (2002, 1, []), (2100, 1, [5, 5]), (2101, 1, [4, 6]),
             (2102, 2, [4, 5]), (2200, 3, [10**9] * 3), (2201, 3, [10**9] * 3), (2202, 1, [10**9] * 3), (2203, 1, [10**9, 10**9, 10**9 - 1])]
    return rows


def test_against_brute_force(spark, rows, monkeypatch):
    anchors = [r for r in rows if r[0] % 100 == 0]
    want = brute(rows, anchors)
    assert len(want) > 60
    assert mine(spark, rows, anchors) == want
    monkeypatch.setattr(H.ZonedFile.build.__func__, "__defaults__", (8,))
    monkeypatch.setattr(H, "ROUND_ANCHORS", 4)
    assert mine(spark, rows, anchors) == want


def test_reads_what_windows_reach(spark, monkeypatch):
    """Clusters far apart: an anchor's blocks are few, and the scan skips the row groups of the others."""
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, [int(x) for x in (i % 16) * 1000 * np.array([1, 2, -1, 1]) + rng.normal(size=4) * 5]) for i in range(1600)]
    anchors = [r for r in rows if r[0] % 160 == 15]
    read = []
    plain = H.in_ranges
    monkeypatch.setattr(H, "in_ranges", lambda *a: read.append(plain(*a)) or read[-1])
    monkeypatch.setattr(H.ZonedFile.build.__func__, "__defaults__", (20,))
    kept = []
    whole = H.ZonedFile.build
    monkeypatch.setattr(H.ZonedFile, "build", lambda r: kept.append(whole(r)) or kept[-1])
    assert mine(spark, rows, anchors) == brute(rows, anchors)
    blocks = kept[0].blocks
    assert len(read) == 2 and blocks.count() >= 80
    for condition in read:
        few = blocks.where(condition)
        assert 0 < few.count() < blocks.count() / 4
        assert "PushedFilters: []" not in few._jdf.queryExecution().executedPlan().toString()


def test_bounds_hold():
    rng = np.random.default_rng(1)
    v = rng.integers(-50, 50, (40, 20, 5))
    q = rng.integers(-50, 50, (9, 5))
    least, most = H.bounds(v.min(axis=1), v.max(axis=1), q)
    scores = np.einsum("znd,ad->azn", v, q)
    assert (least <= scores.min(axis=2)).all() and (most >= scores.max(axis=2)).all()


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 2), (4, 2)])
def test_hilbert_steps_to_neighbours(n, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), axis=-1).reshape(-1, n)
    place = H.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    walked = cells[np.argsort(place)]
    assert (np.abs(np.diff(walked, axis=0)).sum(axis=1) == 1).all()


def test_few_and_none(spark):
    rows = [(0, 1, [256]), (1, 1, [512]), (2, 2, [500]), (3, 2, [100])]
    assert mine(spark, rows, rows[:1]) == [(0, 1, 1, 2, 256 * 512, 256 * 500)]
    assert mine(spark, [], []) == []


def test_odd_rows(spark, monkeypatch):
    """Nulls and non-finite components take no part, further columns may have any name."""
    data = [(0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [1.0, 0.0], 2), (3, None, 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 2),
            (6, [float("inf"), 1.0], 2), (8, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (7, [1.0, 0.25], 1)]
    df = spark.createDataFrame([(*r, 1, "x") for r in data], "vec_id bigint, embedding array<float>, label int, id int, v string")
    monkeypatch.setattr(H, "table", lambda *a: df)
    want = brute([(0, 2, [256, 128]), (1, 1, [256, 64]), (2, 2, [256, 0]), (7, 2, [256, 64])], [(0, 2, [256, 128])])
    assert values(H.op11_hard_negatives(spark, "none"), *COLUMNS) == want


def test_sql(spark):
    assert compare(H.op11_hard_negatives(spark, SF), connect(SF), H.SQL) is None
