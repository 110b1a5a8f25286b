"""Balanced label propagation: documents to shards of equal row counts, linked documents together.

Documents with equal texts are linked with each other, every one with every one. Linked documents of one shard are
alike for the propagation, so its state is a table (text class, shard) -> number of documents instead of one label
per document: exact, and small however large a class is. It starts from a hash of doc_id. In each round a part of a
class moves to the shard where most of its neighbours are, among shards that still have room; arrivals are admitted
in order, large classes first, up to the room of the shard, the last one in part (capacity quotas). That lowers the
number of cut links in every move. After ``ROUNDS`` rounds, or when nothing moves any more, classes get their places, and
documents without links, which cut nothing, fill the places left over, so that row counts differ by one at most.

Only DataFrame functions run: joins, aggregations and windows. Ranks and running sums over large groups are made in
two levels (within hash buckets, then over the few bucket totals), so no key, not even a text with a third of all
rows, is handled by one task.

Edge cases: null texts have size 16, crc32 0 (as the empty text) and no links; empty texts are linked with each
other; repeated doc_ids are placed row by row; null doc_ids are placed too; with fewer documents than shards some
shards stay empty; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.llm import store

KEY = ["k1", "k2"]
ROUNDS = 12


def quotas(n: int, shards: int) -> list[int]:
    """Rows of every shard: sizes at most one apart."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def offsets(df: DataFrame, group: list[str], bucket: str, value: Column) -> DataFrame:
    """(group, bucket, before): total of ``value`` over the smaller buckets of a group. Few rows: one per group and bucket."""
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    w = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    return totals.withColumn("before", F.coalesce(F.sum("_sum").over(w.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))).drop("_sum")


def running(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """Running total of ``value`` before each row within its group, by bucket and then ``order``."""
    own = F.coalesce(F.sum(value).over(W.partitionBy(*group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    before = offsets(df, group, bucket, F.col(value)).withColumnRenamed("before", "_before")
    # groups are shards and buckets are bounded: shards * 4096 rows of 24 bytes at most
    return df.withColumn("_own", own).join(F.broadcast(before), [*group, bucket]).withColumn(name, F.col("_own") + F.col("_before")).drop("_own", "_before")


def pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(int(v)).cast("long") for v in values)), index + 1)


def propagate(state: DataFrame, room_total: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Move parts of classes towards their neighbours' shards under quotas; (k1, k2, shard, n) in and out."""
    shards = len(room_total)
    for _ in range(rounds):
        loads = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row per shard
        room = [max(0, room_total[s] - loads.get(s, 0)) for s in range(shards)]
        tie = F.xxhash64(*KEY, "shard")
        pull = F.struct(F.col("n"), tie.alias("tie"), F.col("shard"))
        goal = state.where(pick(room, F.col("shard")) > 0).groupBy(*KEY).agg(F.max(pull).alias("goal"))
        movers = state.join(goal, KEY).where((pull < F.col("goal")) & (F.col("shard") != F.col("goal.shard")))
        movers = movers.select(*KEY, "shard", "n", F.col("goal.shard").alias("to"), F.col("goal.n").alias("pull"))
        # large classes first: buckets by order of magnitude, then by hash
        rank = F.least(F.floor(F.log2(F.col("n") + F.col("pull"))), F.lit(62))
        movers = movers.withColumn("_b", ((F.lit(62) - rank) * 64 + F.pmod(F.xxhash64(*KEY), F.lit(64))).cast("int"))
        moved = running(movers, ["to"], "_b", [*KEY, "shard"], "n", "before")
        moved = moved.withColumn("go", F.least("n", F.greatest(F.lit(0), pick(room, F.col("to")) - F.col("before")))).where("go > 0")
        moved = store.keep(moved.select(*KEY, "shard", "to", "go"), "sh-moves")
        if not moved.limit(1).count():
            break
        change = moved.select(*KEY, "shard", (-F.col("go")).alias("n")).unionByName(moved.select(*KEY, F.col("to").alias("shard"), F.col("go").alias("n")))
        state = store.keep(state.unionByName(change).groupBy(*KEY, "shard").agg(F.sum("n").alias("n")).where("n > 0"), "sh-state")
    return state


def shard(docs: DataFrame, shards: int = 40, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.xxhash64("text")).alias("k1"),
        F.when(F.col("text").isNotNull(), F.xxhash64(F.lit(7), F.col("text"))).alias("k2"),
    )
    rows = store.keep(rows, "sh-rows")
    n = rows.count()
    caps = quotas(n, shards)
    buckets = min(4096, max(64, n // 20_000))
    large = max(2_000, n // 1_000)  # a class over this is dealt out by salts; there are 1,000 such classes at most
    order = ["doc_id", "text_crc32", "size"]

    sizes = store.keep(rows.where("k1 is not null").groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "sh-classes")
    salts = sizes.where(F.col("copies") > large).select(*KEY, F.ceil(F.col("copies") / large).cast("int").alias("salts"))
    salted = rows.where("k1 is not null").join(F.broadcast(salts), KEY, "left").withColumn("_b", F.coalesce(F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("salts")), F.lit(0)).cast("int"))
    w = W.partitionBy(*KEY, "_b")
    ranked = salted.withColumn("rank", F.row_number().over(w.orderBy(*order)).cast("long") - 1).withColumn("here", F.count(F.lit(1)).over(w))
    linked = ranked.where("here > 1 or salts is not null").drop("here")
    # offsets of salted classes: 2,000 rows at most
    before = offsets(salted.where("salts is not null"), KEY, "_b", F.lit(1))
    linked = linked.join(F.broadcast(before), [*KEY, "_b"], "left").withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0))).withColumn("salted", F.col("salts").isNotNull()).drop("_b", "salts", "before")
    linked = store.keep(linked, "sh-linked")

    first = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")
    state = store.keep(linked.groupBy(*KEY, first.alias("shard")).agg(F.count(F.lit(1)).alias("n")), "sh-state")
    state = propagate(state, caps, rounds)

    # places of the parts within their shards, and of their documents by rank within the class
    parts = running(state.withColumn("_b", F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")), ["shard"], "_b", KEY, "n", "start")
    lo = F.coalesce(F.sum("n").over(W.partitionBy(*KEY).orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    parts = store.keep(parts.select(*KEY, "shard", "n", "start", lo.alias("lo")), "sh-parts")
    within = (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("lo") + F.col("n"))
    plain = linked.where("not salted").join(parts, KEY).where(within)
    # parts of salted classes: 1,000 classes in as many shards each at most
    hot = linked.where("salted").join(F.broadcast(parts.join(F.broadcast(salts.select(*KEY)), KEY)), KEY).where(within)
    seated = plain.unionByName(hot.select(plain.columns)).withColumn("slot", F.col("start") + F.col("rank") - F.col("lo"))
    seated = store.keep(seated.select(*order, "shard", "slot").withColumn("seated", F.col("slot") < pick(caps, F.col("shard"))), "sh-seated")

    load = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    taken = [min(caps[s], load.get(s, 0)) for s in range(shards)]
    ends, total = [], 0
    for s in range(shards):
        total += caps[s] - taken[s]
        ends.append(total)
    alone = rows.where("k1 is not null").join(sizes, KEY, "left_anti").unionByName(rows.where("k1 is null"))
    free = alone.select(*order).unionByName(seated.where("not seated").select(*order)).withColumn("one", F.lit(1).cast("long"))
    free = running(free.withColumn("_b", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int")), [], "_b", order, "one", "place")
    at = F.lit(0)
    for e in ends[:-1]:
        at = at + (F.col("place") >= e).cast("int")
    free = free.withColumn("shard", at).withColumn("slot", F.col("place") - pick([0, *ends[:-1]], F.col("shard")) + pick(taken, F.col("shard")))
    out = seated.where("seated").select(*order, "shard", "slot").unionByName(free.select(*order, "shard", "slot"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
