import random
import zlib
from collections import Counter

from rows import SF, documents, values

from tillworks.llm import sharding as H
from tillworks.llm.common import table

COLUMNS = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def laws(got, rows, shards=16):
    """What must hold for any assignment; returns the shards of each text."""
    want = sorted(((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows), key=repr)
    assert sorted((r[:3] for r in got), key=repr) == want
    assert {r[3] for r in got} <= {"rows"} and {r[6] for r in got} <= {None}
    counts = Counter(r[4] for r in got)
    assert max(counts.get(s, 0) for s in range(shards)) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s, n in counts.items():
        assert sorted(r[5] for r in got if r[4] == s) == list(range(n))
    where = {}
    for r in got:
        where.setdefault((r[1], r[2]), Counter())[r[4]] += 1
    return where


def test_table(spark):
    rows = [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = values(H.op7_sharding(spark, SF), *COLUMNS)
    where = laws(got, rows)
    assert all(len(s) == 1 for s in where.values())  # every group of copies fits a shard
    assert got == values(H.op7_sharding(spark, SF), *COLUMNS)


def test_odd_rows(spark):
    docs = documents(spark)
    laws(values(H.shard_documents(docs), *COLUMNS), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert H.shard_documents(docs.where("doc_id > 99")).count() == 0


def test_hot_group_fills_few_shards(spark):
    """A third of all rows are one text, another third are pairs."""
    texts = ["hot"] * 160 + [f"pair {i // 2}" for i in range(160)] + [f"single {i}" for i in range(160)]
    docs = documents(spark, [(i * 7919 % 480, t, "en", "a") for i, t in enumerate(texts)])
    where = laws(values(H.shard_documents(docs, 16, 12), *COLUMNS), [(r["doc_id"], r["text"]) for r in docs.collect()])
    hot = where[4, zlib.crc32(b"hot")]
    kept = sum(n * (n - 1) // 2 for n in hot.values())
    print(hot, kept)
    assert kept > 1.3 * 16 * 45  # evenly spread they would keep 16 * 45 links
    pairs = [s for (size, _), s in where.items() if sum(s.values()) == 2]
    print(sum(len(s) == 1 for s in pairs))
    assert len(pairs) == 80 and sum(len(s) == 1 for s in pairs) >= 64


def test_all_linked(spark):
    """Without unlinked rows only exchanges are granted; they still cut fewer links than at the start."""
    nodes = [(i, i * 31 % 40) for i in range(160)]
    members = spark.createDataFrame(nodes, "node bigint, hub bigint")
    state = H.propagate(members, [40] * 4, 8)
    assert Counter(r["shard"] for r in state.collect()) == {0: 40, 1: 40, 2: 40, 3: 40}
    begin = members.selectExpr("node", "cast(node % 4 as int) as shard")
    assert H.cut_links(members, state).first()["cut"] <= H.cut_links(members, begin).first()["cut"]


def test_several_hubs_a_node(spark):
    members = spark.createDataFrame([(i, i // 10) for i in range(40)] + [(i, 100 + i // 20) for i in range(0, 40, 2)], "node bigint, hub bigint")
    state = H.propagate(members, [100] * 4, 8)
    begin = members.select("node").distinct().selectExpr("node", "cast(node % 4 as int) as shard")
    assert state.count() == 40 and H.cut_links(members, state).first()["cut"] < H.cut_links(members, begin).first()["cut"] / 2


def test_grants():
    granted = H._grants({(0, 1): 10, (1, 0): 4, (2, 1): 6}, [0, 5, 0])
    assert granted[0, 1] - 4 + granted[2, 1] <= 5 and granted[1, 0] == 4


def _split(spark, texts):
    """Shards of each text with the rounds that the query runs, texts laid over the ids at random."""
    ids = random.Random(7).sample(range(len(texts)), len(texts))
    docs = documents(spark, [(i, t, "en", "a") for i, t in zip(ids, texts)])
    rows = list(zip(ids, texts))
    return laws(values(H.shard_documents(docs), *COLUMNS), rows)


def test_fully_linked_tables_are_joined(spark):
    """Without unlinked rows all groups but those at the edges of shards come together."""
    for size in (2, 4):
        where = _split(spark, [f"group {i // size:04}" for i in range(960)])
        assert len(where) == 960 // size and sum(len(s) > 1 for s in where.values()) <= 15


def test_half_in_one_text_and_pairs(spark):
    """The hot text fills eight shards of sixteen whole, the pairs the others."""
    where = _split(spark, ["hot"] * 480 + [f"pair {i // 2:04}" for i in range(480)])
    hot = where.pop((4, zlib.crc32(b"hot")))
    assert sum(n * (n - 1) // 2 for n in hot.values()) >= 0.9 * 8 * 60 * 59 // 2
    assert sum(len(s) > 1 for s in where.values()) <= 15


def test_grants_go_round():
    granted = H._grants({(0, 1): 3, (1, 2): 4, (2, 0): 2, (3, 0): 5}, [0, 0, 1, 0])
    assert granted == {(0, 1): 3, (1, 2): 3, (2, 0): 2, (3, 0): 1}
