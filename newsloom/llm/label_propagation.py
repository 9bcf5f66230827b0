"""Sharding by balanced label propagation.

Column functions only. Documents with equal texts are linked. Members of a group that are in the same
shard are interchangeable, so what is passed on is a row for each group and shard, at most as many as
shards for a group of any size. Each round joins the groups with their largest shard that has room
and moves members there; a matrix of the wished moves between shards says which share of them each
shard's quota admits. In the end the unlinked documents, and linked ones only beyond the quota, even
out the shards to counts at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ROW, blocks_for, looked_up, numbered, saved, text_or_empty, unit

LAW = "rows"


def admitted(moves: list[list[int]], loads: list[int], quota: int) -> list[float]:
    """The share of moves into each shard such that no shard ends above its quota, given what leaves
    it under the same shares."""
    n = len(loads)
    shares = [1.0] * n
    for _ in range(100):
        after = []
        for d in range(n):
            asked = sum(moves[a][d] for a in range(n))
            leaving = sum(moves[d][b] * shares[b] for b in range(n))
            after.append(max(0.0, min(1.0, (quota - loads[d] + leaving) / asked)) if asked else 0.0)
        if after == shares:
            break
        shares = after
    return shares


def propagate(state: DataFrame, shards: int, quota: int, rounds: int) -> DataFrame:
    """The (group, shard, n) table after moving members towards their group's shards."""
    pull = F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard")
    quota += -(-quota // 20)  # a little more for now: the last step evens out
    for turn in range(rounds):
        loads = [0] * shards  # a number per shard
        for row in state.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            loads[row["shard"]] = row["n"]
        # every other round leaves out full shards, for what is left of groups larger than a shard
        room = F.element_at(F.array(*[F.lit(turn % 2 == 0 or load < quota) for load in loads]), F.col("shard") + 1)
        best = state.where(room).groupBy("group").agg(F.max(pull).alias("best"))
        wished = state.join(best.hint("merge"), "group").where(
            (F.col("n") < F.col("best.n")) | ((F.col("n") == F.col("best.n")) & (F.xxhash64("group", "shard") < F.col("best.tie")))
        ).select("group", "shard", F.col("best.shard").alias("to"), "n")
        wished = saved(wished, "moves")
        matrix = [[0] * shards for _ in range(shards)]  # a number per pair of shards
        for row in wished.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect():
            matrix[row["shard"]][row["to"]] = row["n"]
        shares = admitted(matrix, loads, quota)
        if not any(matrix[a][d] * shares[d] > 0 for a in range(shards) for d in range(shards)):
            if turn % 2:
                break
            continue
        share = F.element_at(F.array(*map(F.lit, shares)), F.col("to") + 1)
        # a large part moves by its share, a small one as a whole with that chance
        count = F.least(F.col("n"), F.floor(F.col("n") * share + unit("group", "shard", F.lit(turn))))
        moved = wished.withColumn("n", count).where("n > 0")
        changes = state.unionByName(moved.select("group", "shard", (-F.col("n")).alias("n"))).unionByName(
            moved.select("group", F.col("to").alias("shard"), "n")
        )
        state = saved(changes.groupBy("group", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "shards-of-groups")
    return state


def _chosen(values, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at.cast("int") + 1)


def shard(
    docs: DataFrame, shards: int = 16, rounds: int = 12, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `docs`: doc_id, size (UTF-8 bytes and one), text_crc32, law, shard, slot
    (its place in the shard, without gaps from 0) and grown_shard (null under this law).

    Shards have counts at most one apart. Documents are linked if their texts are equal, a null text
    being empty with size 1; a group larger than a shard takes several. Repeated rows and ids are
    documents of their own. Other columns are not read; an empty table gives no rows.
    """
    text = text_or_empty(text_col)
    own = unit("doc_id", "group", ROW)
    given = numbered(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("group"),
    ))
    rows = saved(given.withColumn("shard", F.floor(own * shards).cast("int")), "sized")
    total = rows.count()
    quota = -(-total // shards)

    parts = rows.groupBy("group", "shard").agg(F.count("*").alias("n"))
    linked = parts.withColumn("_all", F.sum("n").over(Window.partitionBy("group"))).where("_all > 1").drop("_all")
    state = propagate(saved(linked, "shards-of-groups"), shards, quota, rounds)

    # members take their group's shards by a hash, each with its part of the group
    each = F.array_sort(F.collect_list(F.struct("shard", "n")))
    groups = saved(state.groupBy("group").agg(each.alias("parts"), F.sum("n").alias("members")), "groups")
    upto = F.transform("parts", lambda p, i: F.aggregate(F.slice("parts", F.lit(1), i + 1), F.lit(0).cast("long"), lambda t, q: t + q["n"]))
    place = F.size(F.filter(upto, lambda u: u <= unit("doc_id", ROW, F.lit(1)) * F.col("members")))
    joined = looked_up(rows, groups, "group")
    alone = F.col("parts").isNull()
    blocks = blocks_for(total)
    # a group stays together in the order, unless it alone is more than a block
    together = ~alone & (F.col("members") <= total // blocks)
    spot = F.when(together, unit("group")).otherwise(unit(ROW))
    placed = saved(
        joined.select(
            "doc_id", "size", "text_crc32", "group", ROW,
            F.when(alone, F.col("shard")).otherwise(F.get(F.col("parts.shard"), place)).alias("shard"),
            alone.cast("int").alias("kind"), F.floor(spot * blocks).cast("int").alias("block"),
        ),
        "placed",
    )

    counts = placed.groupBy("shard", "kind", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("kind", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("shard", "kind", "block").orderBy("group", "doc_id", ROW)) - 1
    slots = placed.withColumn("_within", within).join(starts.hint("merge"), ["shard", "kind", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("_within")).alias("slot")
    )

    have = [0] * shards  # a number per shard
    for row in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        have[row["shard"]] = row["n"]
    larger = sorted(range(shards), key=lambda s: (-have[s], s))[:total % shards]
    due = [total // shards + (s in larger) for s in range(shards)]
    over = [max(0, have[s] - due[s]) for s in range(shards)]
    first_over = [sum(over[:s]) for s in range(shards)]
    lack = [max(0, due[s] - have[s]) for s in range(shards)]
    first_lack = [sum(lack[:s]) for s in range(shards)]
    spare = F.col("slot") - _chosen(due, F.col("shard"))  # 0 or more: has to leave
    number = _chosen(first_over, F.col("shard")) + spare
    target = F.lit(0)
    for s in range(shards):
        target = F.when((number >= first_lack[s]) & (number < first_lack[s] + lack[s]), s).otherwise(target)
    moving = spare >= 0
    return slots.withColumn("_to", F.when(moving, target)).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"),
        F.coalesce("_to", "shard").cast("int").alias("shard"),
        F.when(moving, _chosen(have, F.col("_to")) + number - _chosen(first_lack, F.col("_to"))).otherwise(F.col("slot")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
