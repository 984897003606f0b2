"""Operator 9, mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of the source is due target / source size copies, of which
the fraction is rounded. Two documents with fractions are paired and words move between them, at random and fair
in the mean, until one of them has a whole copy or none: their words together stay the same. The other one goes on
to the next pair. Runs of ``FAN`` documents are folded this way side by side, what each run leaves over is folded
again, and so up a tree whose levels are stored tables, until one document per source is left. Long documents have
trees of their own that come first: their last one is rounded at random, and what that misses is shared out over
the shorter documents, whose fractions are set anew. The last document of the shortest is rounded to the nearer
side, so a source misses its target by half of one of its short documents, if those have words enough to make up
for the long ones. ``DRAWS`` trees are drawn independently and each source keeps the one that misses its target least.

Defined results: a null text has no words; the null source is a source, last in order; rows that repeat an id,
source and text are one unit, each taken as often as the others; a source without words has target 0 and its
documents, like all without words, are drawn one by one; an empty table gives an empty result. Only the id, text
and source columns are read.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import stored, table
from tillworks.operators.ranking import with_position

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
FAN = 64
DRAWS = 8
SEED = 20_240_229
WORD = r"[^\x20\x09-\x0D]+"

_DRAW = f"(pmod(xxhash64({SEED}, %s, %s, %s), 9007199254740992) / 9007199254740992D)"


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words of each source: shares by weight, none above ``most`` times its size, the excess shared out again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, active, out = share * sum(sizes.values()), list(order), {}
    while active:
        unit = left / sum(weight[s] for s in active)
        full = [s for s in active if unit * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in active}
        for s in full:
            out[s] = float(most * sizes[s])
            left -= out[s]
        active = [s for s in active if s not in out]
    return out


def _folded(units: DataFrame, width: int) -> DataFrame:
    """One step up the trees: (src, draw, run, x, taken) for runs of neighbours.

    units: src, draw, at (place in the order), x = struct(node, s words, m words still due, 0 < m < s).
    The fold carries the one open unit; of it (a) and the next (b), whole copies are put into taken.
    """
    up = "least(a.s - a.m, b.m)"  # words that can move to a, and below to b
    down = "least(a.m, b.s - b.m)"
    draw = _DRAW % ("draw", "a.node", "b.node")
    step = f"""(acc, b) -> if(acc.x is null, named_struct('x', b, 'taken', acc.taken),
        transform(array(acc.x), a ->
            if({draw} * ({up} + {down}) < {down},
               if(a.s - a.m <= b.m,
                  named_struct('x', named_struct('node', b.node, 's', b.s, 'm', b.m - (a.s - a.m)), 'taken', concat(acc.taken, array(a.node))),
                  named_struct('x', named_struct('node', a.node, 's', a.s, 'm', a.m + b.m), 'taken', acc.taken)),
               if(a.m <= b.s - b.m,
                  named_struct('x', named_struct('node', b.node, 's', b.s, 'm', b.m + a.m), 'taken', acc.taken),
                  named_struct('x', named_struct('node', a.node, 's', a.s, 'm', a.m - (b.s - b.m)), 'taken', concat(acc.taken, array(b.node))))))[0])"""
    start = "named_struct('x', cast(null as struct<node:bigint,s:double,m:double>), 'taken', cast(array() as array<bigint>))"
    runs = units.groupBy("src", "draw", F.floor(F.col("at") / width).alias("run")).agg(F.array_sort(F.collect_list("x")).alias("xs"))
    # what an exact fit leaves over is whole or nothing already
    return runs.select("src", "draw", "run", F.expr(f"aggregate(xs, {start}, {step})").alias("f")).select("src", "draw", "run", "f.x", "f.taken")


def _passes(words: dict[int, float], part: float) -> dict[int, int]:
    """The pass, counted from the shortest, of each class of lengths (powers of two) of a source.

    A pass takes in the classes whose largest document the shorter passes can make up for; the first one all that
    it needs to make up for a document of the next class.
    """
    slack = min(part, 1 - part)
    out, g, below, seen = {}, 0, 0.0, 0.0
    for c in sorted(words):
        longest = 2.0 ** (c + 1)
        if g == 0 and seen * slack >= longest or g > 0 and below * slack < longest and seen > below:
            g, below = g + 1, seen
        out[c] = g
        seen += words[c]
    return out


def _rounded(m: float, s: float, due: float, rest: float, last: bool, seed: str) -> bool:
    """Whether the open unit is taken: at random if the rest can make up for both sides, else what it misses less."""
    def lack(after: float) -> float:
        return max(0.0, -after, after - rest)

    take, leave = lack(due + m - s), lack(due + m)
    if last or abs(take - leave) > 1e-6:
        return m * 2 >= s if last else take < leave
    return random.Random(seed).random() * s < m


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, source, same, n, size, source_size, target, copies), a row per unit.

    same is a hash of the text; n rows of docs are of this unit and each of them is to be taken ``copies`` times.
    """
    spark = docs.sparkSession
    own = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
                      F.xxhash64("text").alias("same"))
    grouped = own.groupBy("doc_id", "source", "size", "same").agg(F.count("*").alias("n"))
    units = stored(with_position(grouped, ["source", F.desc(F.col("size") * F.col("n")), F.xxhash64(F.lit(SEED), "doc_id", "same"), "doc_id", "same"], "node", start=0), "mix-units")
    total = units.count()
    sizes = {s: int(n) for s, n in units.groupBy("source").agg(F.sum(F.col("size") * F.col("n"))).collect()}  # a row per source
    due = targets(sizes, weights, share, most)
    plan = spark.createDataFrame(
        [(i, s, sizes[s], float(due[s])) for i, s in enumerate(due)], "src int, name string, source_size bigint, target double")
    units = units.join(plan, units["source"].eqNullSafe(plan["name"])).drop("name")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    words = (F.col("size") * F.col("n")).cast("double")
    units = units.withColumn("whole", F.floor(ratio).cast("int")).withColumn("part", ratio - F.floor(ratio))
    parts = {i: due[s] / sizes[s] - int(due[s] / sizes[s]) if sizes[s] else 0.0 for i, s in enumerate(due)}
    units = units.withColumn("class", F.when(words > 0, F.length(F.bin(words.cast("bigint"))) - 1))
    held: dict[int, dict[int, float]] = {}
    for i, c, n in units.where("class is not null").groupBy("src", "class").agg(F.sum(words)).collect():  # 64 rows a source at most
        held.setdefault(i, {})[c] = n
    passes = {(i, c): g for i, w in held.items() if parts[i] > 0 for c, g in _passes(w, parts[i]).items()}
    classed = spark.createDataFrame([(*k, g) for k, g in passes.items()], "src int, class int, pass int")
    split = stored(units.join(F.broadcast(classed), ["src", "class"]).select("src", "node", words.alias("s"), "pass"), "mix-classes")
    left = {(i, k): parts[i] * sum(held[i].values()) for i, _ in passes for k in range(DRAWS)}  # words due
    rest = {i: sum(held[i].values()) for i, _ in passes}
    levels, opened = [], []
    for g in range(max(passes.values(), default=-1), -1, -1):
        now = {i: sum(n for c, n in held[i].items() if passes[i, c] == g) for i in rest}
        share = {(i, k): min(1.0, max(0.0, d / rest[i])) for (i, k), d in left.items() if now[i]}
        shares = spark.createDataFrame([(*k, f) for k, f in share.items()], "src int, draw int, f double")  # draws a source
        mine = split.where(F.col("pass") == g).join(F.broadcast(shares), "src")
        levels.append(mine.where("f >= 1").select("src", "draw", "node"))
        level = mine.where("f > 0 and f < 1").select(
            "src", "draw", F.col("node").alias("at"), F.struct("node", "s", (F.col("s") * F.col("f")).alias("m")).alias("x"))
        width = 1
        while width < max(total, 2):
            width *= FAN
            level = stored(_folded(level, width), "mix-level")
            levels.append(level.select("src", "draw", F.explode("taken").alias("node")))
            level = level.select("src", "draw", (F.col("run") * width).alias("at"), "x")
        for i in rest:
            rest[i] -= now[i]
        for i, k in share:
            left[i, k] -= share[i, k] * now[i]
        for i, k, x in level.select("src", "draw", "x").collect():  # draws a source
            if x is not None:
                taken = _rounded(x.m, x.s, left[i, k], rest[i], g == 0, f"{SEED} {i} {k} {g}")
                left[i, k] += x.m - x.s * taken
                if taken:
                    opened.append((i, k, x.node))
    chosen = spark.createDataFrame(
        [(i, min(range(DRAWS), key=lambda k: (round(abs(left[i, k]), 6), k))) for i in rest], "src int, draw int")
    more = spark.createDataFrame(opened, "src int, draw int, node bigint")
    for part in levels:
        more = more.union(part)
    lone = units.where((F.col("size") == 0) & (F.expr(_DRAW % ("0", "node", "size")) < F.col("part"))).select("node")
    more = more.join(chosen, ["src", "draw"]).select("node").union(lone).withColumn("more", F.lit(1))
    return units.join(more, "node", "left").select(
        "doc_id", "source", "same", "n", "size", "source_size", "target", (F.col("whole") + F.coalesce("more", F.lit(0))).alias("copies"))


def op9_mixing(spark, sf_dir):
    rows = copies(table(spark, sf_dir, "documents")).withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
