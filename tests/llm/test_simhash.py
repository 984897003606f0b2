import re

import numpy as np
import pytest
import xxhash
from rows import SF, documents, values

from tillworks.llm import components, simhash as S
from tillworks.llm.common import table


def fingerprint(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def labels(fps, bits):
    """Least index in reach of each fingerprint."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def check(got, rows):
    """got: doc_id, fingerprint, component_id; rows: (doc_id, text)."""
    fps = [fingerprint(t) for _, t in rows]
    groups = {}
    for (doc, _), g in zip(rows, labels(fps, 4)):
        groups.setdefault(g, []).append(doc)
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    want = sorted(((doc, f"{f:016x}", least[g]) for (doc, _), f, g in zip(rows, fps, labels(fps, 4))), key=repr)
    assert got == want


def op(docs):
    from pyspark.sql import functions as F

    found = S.near_duplicates(docs)
    return values(found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id"), "doc_id", "f", "component_id")


def test_odd_rows(spark):
    docs = documents(spark)
    check(op(docs), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    check(values(S.op3_simhash(spark, SF), "doc_id", "fingerprint", "component_id"), rows)


def test_empty(spark):
    assert op(spark.createDataFrame([], "doc_id bigint, text string")) == []


@pytest.mark.parametrize("max_bits,segment,point_rows", [(4, 2, 4096), (4, 2, 20), (4, 4, 60), (3, 2, 4096), (7, 2, 4096)])
def test_links_connect_what_is_near(spark, max_bits, segment, point_rows):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**64, 12, dtype=np.uint64)
    fps = set(map(int, rng.integers(0, 2**64, 150, dtype=np.uint64)))
    for c in centres:  # dense clouds and chains
        for _ in range(40):
            flips = rng.choice(64, rng.integers(1, 8), replace=False)
            fps.add(int(c) ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    found = S.links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), max_bits, segment, point_rows).collect()
    for a, b in found:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits
    place = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == labels(fps, max_bits)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (60, 50), (55, 60), (55, 50)]
    got = dict(components.roots(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 0 for i in range(31)}, **{k: 100 for k in range(100, 140)}, 50: 50, 55: 50, 60: 50}
    assert components.roots(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_representatives(spark):
    docs = documents(spark)
    kept = S.representatives(S.near_duplicates(docs)).collect()
    assert sorted(((r["id"], r["n"]) for r in kept), key=repr) == sorted([(1, 1), (2, 1), (5, 1), (7, 1), (8, 1), (9, 1), (None, 2)], key=repr)
