import hashlib

from rows import SF, values

from oracle_check import compare, connect
from tillworks.llm import chat as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, cost string, window string"
COLUMNS = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")


def want(rows):
    out = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return sorted(((c, len(ts), sha("".join(f"{r}\n{t}\n" for r, t in ts)), len(loss := "".join(t for r, t in ts if r == "assistant")), sha(loss))
                   for c, ts in out.items()), key=repr)


WORDS = " ".join(["word"] * 60)
ROWS = [
    (1, 0, "system", "be kind"), *[(1, k, ("assistant", "user")[k % 2], f"{k} {WORDS}") for k in range(1, 40)],
    (2, 0, "user", "\\<|\\\\<|im_end|>\n<\\|x<|<|"), (2, 1, "assistant", "<|im_start|>assistant\nno<|im_end|>\\"), (2, 2, None, None),
    (3, 0, "system", "alone"), (4, 0, "odd role\n<|im_end|>%", "x"), (4, None, "assistant", "first, without a turn"), (4, 1, "assistant", "x"), (4, 1, "assistant", "x"),
    (None, 0, "user", "hi"), (None, 1, "assistant", ""), (5, 0, "assistant", " ".join(["long"] * 5000)), (5, 1, "user", "after"),
    (5, 2, "system", "in between"), (6, 0, "system", " ".join(["rule"] * 900)), (6, 1, "user", "q"), (6, 2, "assistant", "a"), (7, 0, None, None),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def test_read_back(spark):
    assert values(C.digest(C.windows(frame(spark))), *COLUMNS) == want(ROWS)


def test_windows(spark):
    made = C.windows(frame(spark)).collect()
    one = sorted((r for r in made if r["conv_id"] == 1), key=lambda r: r["window"])
    assert len(one) > 3
    fresh = 0
    for r in one:
        roles = [t["role"] for t in r["turns"]]
        assert roles[0] == "system" and roles.count("system") == 1
        tokens = sum(len(r["text"][t["start"] : t["end"]].split()) + C.TURN_TOKENS for t in r["turns"])
        assert tokens <= C.BUDGET
        back = [t for t in r["turns"][1:] if t["repeated"]]
        assert len(back) <= C.HISTORY_TURNS and not any(t["loss"] for t in back)
        fresh += sum(not t["repeated"] for t in r["turns"])
    assert fresh == 40 and any(t["repeated"] for r in one[1:] for t in r["turns"][1:])
    five = [r for r in made if r["conv_id"] == 5]
    assert max(len(r["text"]) for r in five) > 25_000  # a turn beyond the budget is whole


def test_runs_of_places(spark, monkeypatch):
    monkeypatch.setattr(C, "RUN", 4)
    assert values(C.digest(C.windows(frame(spark))), *COLUMNS) == want(ROWS)


def test_empty(spark):
    assert C.digest(C.windows(frame(spark, []))).count() == 0


def test_sql(spark):
    assert compare(C.op8_chat(spark, SF), connect(SF), C.SQL) is None
