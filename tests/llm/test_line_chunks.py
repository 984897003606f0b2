import re

from rows import SF, documents, values

from oracle_check import compare, connect
from tillworks.llm import line_chunks as L

BLOCK = "\n".join(f"shared line {i} of a block" for i in range(12))


def brute(rows):
    """Windows in plain loops: texts without repeated chunks, by row."""
    import hashlib

    def ends(lines):
        h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
        for i in range(1, len(lines)):
            chars = len(lines[i - 1]) + len(lines[i])
            if (h[i - 1] * 31 + h[i]) % L._P % L.SPAN < chars or (i == len(lines) - 1 and chars):
                yield i

    order = sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    first, gone = {}, {}
    for d, t in order:
        lines = t.split("\n")
        cut = gone.setdefault((d, t), set())
        places = list(ends(lines))
        for k, e in enumerate(places):
            low = places[k - 1] if k else 0
            high = places[k + 1] if k + 1 < len(places) else len(lines)
            old, oe, olow, ohigh = first.setdefault((lines[e - 1], lines[e]), (lines, e, low, high))
            if old is lines and oe == e:
                continue
            a, b = e - 1, e + 1
            while a > low and oe - (e - a) - 1 >= olow and lines[a - 1] == old[oe - (e - a) - 1]:
                a -= 1
            while b < high and oe + (b - e) < ohigh and lines[b] == old[oe + (b - e)]:
                b += 1
            cut.update(range(a, b))
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        lines = t.split("\n")
        out.append((d, "\n".join(x for i, x in enumerate(lines) if i not in gone[d, t]), len(lines), len(gone[d, t])))
    return sorted(out, key=repr)


def test_odd_rows(spark):
    extra = [(20, f"start of one\n{BLOCK}\nend", "en", "a"), (21, f"other start\nwith two lines\n{BLOCK}", "en", "a"),
             (22, f"{BLOCK}\n{BLOCK}\n{BLOCK}", "en", "a"), (23, "\n\n\n\n", "en", "a"), (24, "\n\n\n\n", "en", "a")]
    from rows import TEXTS

    docs = documents(spark, [*TEXTS, *extra])
    got = L.without_repeats(docs)
    assert got.columns[: len(docs.columns)] == docs.columns and got.columns[-3:] == ["_n_lines", "n_removed", "_removed"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert values(got, "doc_id", "text", "_n_lines", "n_removed") == brute(rows)
    assert sum(r["n_removed"] for r in got.collect()) >= 30


def test_empty(spark):
    assert L.without_repeats(documents(spark).where("doc_id > 99")).count() == 0


def test_sql(spark):
    assert compare(L.op4_line_chunks(spark, SF), connect(SF), L.SQL) is None
    assert not re.search("Python|Arrow", L.op4_line_chunks(spark, SF)._jdf.queryExecution().toString())


def test_columns_of_any_name(spark):
    docs = documents(spark)
    got = L.without_repeats(docs)
    extra = [c for c in docs.columns if c.startswith("__")]
    assert {tuple(r) for r in got.select(*extra).collect()} == {tuple(f"c-{c}" for c in extra)}


def test_recall_of_passages(spark):
    """Passages of over 50 words in 2 to 6 lines, each in documents of its own among other lines."""
    import random

    rng = random.Random(5)

    def line(words):
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(words))

    rows, planted = [], {}
    for n in range(300):
        size = 2 + n % 5
        passage = [line(52 // size + 1) for _ in range(size)]
        for copy in range(3):
            doc = [line(rng.randint(3, 20)) for _ in range(rng.randint(1, 8))] + passage + [line(rng.randint(3, 20)) for _ in range(rng.randint(1, 8))]
            rows.append((3 * n + copy, "\n".join(doc)))
            planted[3 * n + copy] = (passage, len(doc))
    got = {r["doc_id"]: r for r in L.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    lost = whole = 0
    for i, (passage, lines) in planted.items():
        left = got[i]["text"].split("\n")
        if i % 3 == 0:
            assert got[i]["n_removed"] == 0 and len(left) == lines
        else:
            assert got[i]["n_removed"] <= len(passage), "lines of its own stay"
            assert len(left) == lines - got[i]["n_removed"]
            whole += 1
            lost += not set(left) & set(passage)
    assert lost >= 0.9 * whole, (lost, whole)
