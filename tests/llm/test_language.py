import numpy as np
import zlib
from rows import SF, documents, values

from tillworks.llm import language as G
from tillworks.llm.common import table


def phrases(s, known):
    n = i = 0
    while i < len(s):
        j = i + 1
        while j <= len(s) and s[i:j] in known:
            j += 1
        i, n = max(i + 1, j - 1), n + 1
    return n


def test_phrases_against_brute_force():
    samples = (("a", "the cat sat on the mat, " * 3), ("b", "le chat est sur le tapis. " * 3))
    m = G.Model(samples)
    for text in ("the chat sat sur le mat", "cat", "ÑÑ zzz the", "le " * 300, "x", "字 the 𝒳𠀀"):
        s = m.symbols(text)
        for k, (_, t) in enumerate(samples):
            known = bytes(m.symbols(t).tolist())
            want = sum(phrases(bytes(s[i : i + G.STRETCH].tolist()), known) for i in range(0, len(s), G.STRETCH))
            assert m.phrases([s, s])[:, k].tolist() == [want, want]


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    rows = {r["doc_id"]: r["lang"] for r in table(spark, sf, "documents").select("doc_id", "lang").collect()}
    got = G.op10_language(spark, sf).collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    out = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == rows[r["doc_id"]] for r in out]) > 0.99


def test_odd_rows(spark):
    docs = documents(spark)
    got = values(G.identify(docs), "doc_id", "lang_pred", "score")
    assert {r[1:] for r in got if r[0] in (2, 3, 4, 8)} == {("und", 0.0)}
    assert all(r[1] in ("en", "es", "de") for r in got if r[0] in (1, 5, 7, 9)) and len(got) == 12
    assert G.identify(docs.where("doc_id > 99")).count() == 0


def test_labels_are_no_input(spark):
    from pyspark.sql import functions as F

    docs = table(spark, SF, "documents")
    labelled = G.sample(docs)
    blind = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 5000)
    got = {r["doc_id"] - 5000: (r["lang_pred"], r["score"]) for r in G.predict(blind, labelled).collect()}
    assert got == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in G.predict(docs, labelled).collect()}


def test_nothing_or_one_label_learned(spark):
    from pyspark.sql import functions as F

    docs = documents(spark)
    assert {r["lang_pred"] for r in G.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    one = G.identify(docs.withColumn("lang", F.lit("zz"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in one} == {("zz", 1.0), ("und", 0.0)}


def test_letters_without_a_symbol_are_spelled():
    m = G.Model((("a", "abc 語字"), ("b", "xyz")))
    assert m.digits == 9 and m.symbols("A Б").tolist()[:2] == m.symbols("a б").tolist()[:2]
    seen = {}
    for c in "БбЖж字𠀀𠀁":
        seen.setdefault(tuple(m.symbols(c).tolist()), set()).add(c.lower())
    assert all(len(same) == 1 for same in seen.values()) and {len(k) for k in seen} == {1, 3, 4}


def _invented(rng, letters, words=1500):
    return ["".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(words)]


def test_scripts_of_many_letters(spark):
    """Two languages over the same 2,000 letters, told apart by their words; short texts."""
    import random

    rng = random.Random(3)
    letters = [chr(0x4E00 + 7 * i) for i in range(2000)]
    vocabulary = {lang: _invented(rng, letters) for lang in ("aa", "bb")}

    def text(lang, words):
        return " ".join(rng.choices(vocabulary[lang], k=words))

    rows = [(i, text("ab"[i % 2] * 2, 300), "ab"[i % 2] * 2) for i in range(300)]
    labelled = G.sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    short = [(i, text("ab"[i % 2] * 2, 5)) for i in range(400)]
    got = G.predict(spark.createDataFrame(short, "doc_id bigint, text string"), labelled).collect()
    for k in (0, 1):
        assert np.mean([r["lang_pred"] == "ab"[k] * 2 for r in got if r["doc_id"] % 2 == k]) >= 0.95


def test_every_label_is_learned(spark):
    """More labels than the sample would hold at its full size: the rarest, too, is predicted."""
    import random

    rng = random.Random(4)
    vocabulary = {f"l{k:02}": _invented(rng, "abcdefghijklmnopqrstuvwxyz", 40) for k in range(70)}
    rows = [(i, " ".join(rng.choices(vocabulary[f"l{k:02}"], k=60)), f"l{k:02}") for i, k in enumerate([*list(range(69)) * 12, 69, 69, 69, 69])]
    labelled = G.sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert [lang for lang, _ in labelled] == sorted(vocabulary)
    ask = [(k, " ".join(rng.choices(vocabulary[f"l{k:02}"], k=40))) for k in range(70)]
    got = {r["doc_id"]: r["lang_pred"] for r in G.predict(spark.createDataFrame(ask, "doc_id bigint, text string"), labelled).collect()}
    assert sum(got[k] == f"l{k:02}" for k in got) >= 67 and got[69] == "l69"
