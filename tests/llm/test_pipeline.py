import pytest
import regex
from rows import SF, documents, values

import corpus_pipeline as P
from test_decontamination import brute as leaks
from test_simhash import fingerprint, labels
from tillworks.llm import decontamination, token_files
from tillworks.llm.common import stored, table

SCHEMA = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_the_table(spark):
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    steps = dict(P.STAGES)

    known = stored(steps["language"](spark, docs, SF), "t1")
    assert known.columns == SCHEMA
    ids = sorted(r["doc_id"] for r in known.collect())
    assert ids == sorted(d for d, t in rows.items() if t and regex.search(r"\p{L}", t))

    single = stored(steps["near duplicates"](spark, known, SF), "t2")
    assert single.columns == SCHEMA
    kept = sorted(r["doc_id"] for r in single.collect())
    groups = labels([fingerprint(rows[d]) for d in ids], 4)
    assert kept == sorted({ids[g] for g in groups})

    clean = stored(steps["decontamination"](spark, single, SF), "t3")
    assert clean.columns == SCHEMA
    left = sorted(r["doc_id"] for r in clean.collect())
    assert left == sorted(r[0] for r in leaks([(d, rows[d]) for d in kept], items) if not r[5])

    mixed = stored(steps["mixing"](spark, clean, SF), "t4")
    assert mixed.columns == SCHEMA
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(counts) <= set(left) and max(counts.values()) == 2

    out = steps["token files"](spark, mixed, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(d for d, n in counts.items() for _ in range(n))
    assert {r["doc_id"]: r["n_tokens"] for r in out} == {d: len(token_files.encoder(None)(rows[d])) + 1 for d in counts}


def test_stages_on_odd_rows(spark):
    docs = documents(spark)
    steps = dict(P.STAGES)
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns, name
        none = stage(spark, docs.where("doc_id > 99"), SF)
        assert none.count() == 0, name
    assert values(steps["language"](spark, docs, SF), "doc_id") == sorted([(None,), (None,), (1,), (5,), (6,), (6,), (7,), (9,)], key=repr)
    assert values(steps["near duplicates"](spark, docs, SF), "doc_id") == sorted([(None,), (1,), (2,), (5,), (7,), (8,), (9,)], key=repr)
    assert steps["decontamination"](spark, docs, SF).count() == docs.count()
    assert steps["token files"](spark, docs, SF).count() == docs.count()


def test_run(spark):
    got = P.run(spark, SF)
    assert got.count() > 0 and got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got.collect())
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert decontamination.WINDOW == 10


def test_contaminated_rows_of_null_and_repeated_ids(spark):
    """Only the rows with the benchmark's words go, not those that share their id."""
    leak = table(spark, SF, "benchmark").where("item_id is not null and size(split(text, ' ')) > 12").first()["text"]
    docs = documents(spark, [(None, leak, "en", "a"), (None, "clean text", "en", "a"), (None, None, "en", "a"),
                             (1, f"so {leak}", "en", "a"), (1, "other clean text", "en", "a"), (2, leak, "en", "b")])
    got = P.drop_contaminated(spark, docs, SF)
    assert values(got, "doc_id", "text") == sorted([(None, "clean text"), (None, None), (1, "other clean text")], key=repr)


def test_language_stage_without_labels(spark):
    """Nothing to learn from: all texts with letters stay; a label named as the unknown one is a label."""
    for lang in (None, "und"):
        docs = documents(spark, [(1, "clean text", lang, "a"), (2, None, lang, "a"), (3, "12 3!", lang, "a"), (None, "\u6f22", lang, "a"), (5, "", lang, "a")])
        assert values(P.keep_known_languages(spark, docs, SF), "doc_id") == sorted([(1,), (None,)], key=repr)


def test_contaminated_by_an_item_without_id(spark, tmp_path):
    leak = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(None, leak), (1, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, [(1, f"so {leak}", "en", "a"), (2, "clean text", "en", "a")])
    assert values(P.drop_contaminated(spark, docs, str(tmp_path)), "doc_id") == [(2,)]


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES][:-1])
def test_stages_keep_columns_of_any_name(spark, name):
    """Columns named like the stages' own come back with their values."""
    docs = documents(spark)
    kept = stored(dict(P.STAGES)[name](spark, docs, SF), "t-clash")
    assert kept.columns == docs.columns
    extra = [c for c in docs.columns if c not in SCHEMA]
    assert {tuple(r) for r in kept.select(*extra).collect()} == {tuple(f"c-{c}" for c in extra)}
