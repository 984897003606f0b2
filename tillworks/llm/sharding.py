"""Operator 7, sharding by balanced label propagation.

Documents are linked by hubs: all members of a hub (here: documents of equal text) are neighbours, and a hub of
n members stands for its n * (n - 1) / 2 links without listing them. Every round counts a hub's members by shard,
lets each document prefer the shard that holds most of its neighbours and still has room, and grants moves under quotas: from shard i
to j as many as move from j to i, beyond that only into the room that j has left, and round closed ways of three
shards or more. Rounds go on until none grants a move. Hubs that are still split then leave their seats and are
seated one after the other, the largest first, so that only those at the edge of a shard stay split; all hubs are, if
that cuts fewer links. Linked documents never exceed a shard's quota, and documents without links fill the shards at the end, so
counts differ by one at most (law ``rows``). A hub too large for a shard fills one shard after the other.

Defined results: a null text has size 1, checksum 0 and counts as equal to other null texts, not to empty ones;
null ids and repeated rows are rows like any other; shards beyond the number of rows stay empty; an empty table
gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.common import stored, table
from tillworks.operators.ranking import with_group_position, with_position

SHARDS = 16


def _grants(flows: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Moves granted per pair of shards: exchanges, then the room left, in proportion to those who wait, then longer ways."""
    granted = {(i, j): min(n, flows.get((j, i), 0)) for (i, j), n in flows.items()}
    for j in range(len(room)):
        waiting = {i: n - granted[i, j] for (i, to), n in flows.items() if to == j and n > granted[i, j]}
        total = sum(waiting.values())
        seen = 0
        for i, n in sorted(waiting.items()):  # shares of the running sum, so that all room is granted
            granted[i, j] += n if total <= room[j] else room[j] * (seen + n) // total - room[j] * seen // total
            seen += n
    left = list(room)
    for (i, j), n in granted.items():
        left[i] += n
        left[j] -= n
    rest = {p: n - granted[p] for p, n in flows.items() if n > granted[p]}
    while way := _way(rest, left):
        n = min(rest[p] for p in way)
        start, end = way[0][0], way[-1][1]
        if start != end:
            n = min(n, left[end])
            left[start] += n
            left[end] -= n
        for p in way:
            granted[p] += n
            rest[p] -= n
            if not rest[p]:
                del rest[p]
    return granted


def _way(rest: dict[tuple[int, int], int], left: list[int]) -> list[tuple[int, int]]:
    """The shortest way over waiting moves that is closed or ends where room is left; empty if there is none."""
    best: list[tuple[int, int]] = []
    for start in range(len(left)):
        before, queue, way = {start: start}, deque([start]), []
        while queue and not way:
            i = queue.popleft()
            for j in range(len(left)):
                if (i, j) in rest and (j == start or j not in before and left[j] > 0):
                    way = [(i, j)]
                    break
                if (i, j) in rest and j not in before:
                    before[j] = i
                    queue.append(j)
        while way and way[0][0] != start:
            way.insert(0, (before[way[0][0]], way[0][0]))
        if way and (not best or len(way) < len(best)):
            best = way
    return best


def _pairs_in(pairs: dict[tuple[int, int], int]) -> Column:
    """Granted moves of a row's (shard, pref); shards squared at most."""
    out = F.lit(0)
    for (i, j), n in pairs.items():
        out = F.when((F.col("shard") == i) & (F.col("pref") == j), F.lit(n)).otherwise(out)
    return out


def propagate(members: DataFrame, quotas: list[int], rounds: int | None = None) -> DataFrame:
    """(node, shard) of all linked nodes.

    members: (node, hub), any number of hubs a node; nodes are numbered from 0 over all rows, linked or not, and
    node n starts in shard n % shards. quotas: rows that each shard takes. Without ``rounds`` it ends when neither
    wishes for shards with room nor wishes for any shard bring a move. Where nodes have one hub each, all members
    of a hub want the same shard, so every move joins more links than it cuts and there is such an end; nodes of
    several hubs could swap seats for ever and need ``rounds``.
    """
    shards = len(quotas)
    state = stored(members.select("node").distinct().withColumn("shard", (F.col("node") % shards).cast("int")), "shard-labels")
    r, idle, anywhere = 0, 0, False
    while idle < 2 and (rounds is None or r < rounds):
        held = dict(state.groupBy("shard").count().collect())  # a row per shard
        room = [q - held.get(s, 0) for s, q in enumerate(quotas)]
        free = [s for s in range(shards) if room[s] > 0]
        if anywhere or not free:
            free = list(range(shards))
        seated = members.join(state, "node")
        of_hub = seated.groupBy("hub").agg(*[F.count(F.when(F.col("shard") == s, 1)).alias(f"c{s}") for s in range(shards)])
        votes = seated.join(of_hub, "hub").groupBy("node", "shard").agg(
            F.min("hub").alias("hub"), *[F.sum(f"c{s}").alias(f"c{s}") for s in range(shards)])

        def rated(s: int) -> Column:
            """Neighbours, the document among them; equal counts go by a draw of the hub, so that hubs differ and members don't."""
            return F.struct(F.col(f"c{s}").alias("c"), F.xxhash64(F.lit(r), F.lit(s), "hub").alias("drawn"), F.lit(s).alias("s"))

        here = F.coalesce(*[F.when(F.col("shard") == s, rated(s)) for s in range(shards)])
        r += 1
        rates = votes.select("node", "shard", here.alias("here"), F.greatest(here, *[rated(s) for s in free]).alias("best"))
        wish = stored(rates.select("node", "shard", F.col("best.s").alias("pref"), (F.col("best.c") - F.col("here.c")).alias("gain")), "shard-wishes")
        flows = {(i, j): n for i, j, n in wish.where("pref <> shard").groupBy("shard", "pref").count().collect()}  # shards squared
        granted = _grants(flows, room)
        if not any(granted.values()):
            idle, anywhere = idle + 1, not anywhere
            continue
        idle = 0
        whole = {p: n for p, n in granted.items() if n == flows[p]}
        part = {p: n for p, n in granted.items() if 0 < n < flows[p]}
        label = F.when(_pairs_in(whole) > 0, F.col("pref")).otherwise(F.col("shard"))
        if part:
            queued = with_group_position(
                wish.where(_pairs_in(part) > 0).select("node", "shard", "pref", "gain"), ["shard", "pref"], [F.desc("gain"), "node"], "turn")
            goes = queued.where(F.col("turn") <= _pairs_in(part)).select("node", F.col("pref").alias("goes"))
            state = wish.join(goes, "node", "left").select("node", F.coalesce("goes", label).alias("shard"))
        else:
            state = wish.select("node", label.alias("shard"))
        state = stored(state, "shard-labels")
    return state


def seat_split(members: DataFrame, state: DataFrame, quotas: list[int]) -> DataFrame:
    """state with hubs seated one after the other, if that cuts fewer links: the split ones, or all; one hub a node.

    The largest hub comes first and the shard with most room is filled first, each before the next one begins.
    """
    hubs = stored(members.join(state, "node").groupBy("hub").agg(
        F.count("*").alias("n"), (F.min("shard") < F.max("shard")).alias("split")), "shard-split-hubs")
    if hubs.where("split").isEmpty():
        return state
    best, least = state, cut_links(members, state).first()["cut"]
    for loose in (hubs.where("split"), hubs):
        moved = members.join(loose, "hub").select("node", "hub", "n")
        whole = state.join(moved.select("node"), "node", "left_anti").select("node", "shard")
        held = dict(whole.groupBy("shard").count().collect())  # a row per shard
        line = with_position(moved, [F.desc("n"), "hub", "node"], "turn", start=0)
        seat, at = F.lit(None).cast("int"), 0
        for room, s in sorted(((q - held.get(s, 0), s) for s, q in enumerate(quotas)), key=lambda x: (-x[0], x[1])):
            if room > 0:
                seat = F.when(F.col("turn") >= at, F.lit(s)).otherwise(seat)
                at += room
        labels = stored(whole.union(line.select("node", seat.alias("shard"))), "shard-labels")
        cut = cut_links(members, labels).first()["cut"]
        if cut < least:
            best, least = labels, cut
    return best


def cut_links(members: DataFrame, state: DataFrame) -> DataFrame:
    """(links, cut): all links of the hubs, and those between shards."""
    here = members.join(state, "node").groupBy("hub", "shard").agg(F.count("*").alias("n"))
    hubs = here.groupBy("hub").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("kept"))
    pairs = F.col("n") * F.col("n")
    return hubs.agg(F.sum((pairs - F.col("n")) / 2).cast("bigint").alias("links"), F.sum((pairs - F.col("kept")) / 2).cast("bigint").alias("cut"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of docs."""
    own = docs.select(
        "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.coalesce(F.sha2("text", 256), F.lit("")).alias("same"))
    rows = stored(with_position(own, ["doc_id", "same"], "node", start=0), "shard-rows")
    n = rows.count()
    quotas = [n // shards + (s < n % shards) for s in range(shards)]
    hubs = rows.groupBy("same").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").select("same", "hub")
    hubs = stored(hubs, "shard-hubs")  # joined on an exchange of its own, so that a hot group's rows can be split
    members = stored(rows.join(hubs, "same").select("node", "hub"), "shard-members")
    linked = seat_split(members, propagate(members, quotas, rounds), quotas)
    held = dict(linked.groupBy("shard").count().collect())  # a row per shard
    alone = with_position(rows.select("node").join(linked, "node", "left_anti"), ["node"], "turn", start=0)
    starts, at = [], 0
    for s in range(shards):
        starts.append(at)
        at += quotas[s] - held.get(s, 0)
    fill = F.lit(0)
    for s in range(shards):
        if quotas[s] > held.get(s, 0):
            fill = F.when(F.col("turn") >= starts[s], F.lit(s)).otherwise(fill)
    labels = linked.select("node", "shard").union(alone.select("node", fill.alias("shard")))
    seated = rows.join(labels, "node").select("doc_id", "size", "text_crc32", "shard", "node")
    return with_group_position(seated, ["shard"], ["node"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op7_sharding(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))
