"""Mixing sources to target weights by Pfair scheduling.

Every source is a stream, cut into units of half a block, its documents in an order by hash. With ``w`` the target
weight, a stream is owed ``w * t`` units after t slots. Periods of ``period`` slots share that out in whole numbers: of
the streams' running sums of weights W(i), stream i has had ``floor(m * period * W(i)) - floor(m * period * W(i - 1))`` units
after m periods, which is less than one unit off what it is owed and adds up exactly, for any real weights. Within a
period with q units of a stream, unit k (from 0) is released at slot ``floor(k * period / q)`` and due before slot
``ceil((k + 1) * period / q)``; in each slot the released unit with the earliest deadline goes out, which keeps every stream
less than one unit off again. So after any number of slots every stream is less than two units, one block, off its
target, and does not drift. Periods do not depend on each other: the schedule is made by a fold over the slots of a
period, one row per period, in parallel.

A document takes the slot of the unit that its first byte falls in. Sources owed under two units a period are too
small for whole numbers: however many there are, they share one stream, in which a document stands at (bytes of its
source up to a point in it) / (weight of the source), so that each has its share of that stream but for about a document.

The targets hold (``in_mix``) until the first source with a weight runs out; all later documents come after that, in the
order in which their units are released. A source of weight 0 gets no slot. ``blend`` writes all documents.

Only DataFrame functions run. Running byte counts are made in two levels, so a source with a third of all rows is
dealt out like any other; weights reach such a source by broadcast, others by a join.

Edge cases: null source is a source; null and empty texts count 16 bytes like the header of any other row; null and
repeated doc_ids are mixed row by row; an empty table gives an empty result; weights that are missing count as 0;
without any positive weight of a source at hand, or with a negative or non-finite one, ValueError.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.llm import skew, store

PERIOD, BLOCK_BYTES, POWER = 1_024, 16_384, 0.8
#: Weights are whole parts of this: exact but for a unit in 2**37 slots, with products in 64 bits up to 2**25 periods.
PARTS_BITS = 38
SOURCE = ["_null", "_name"]


def parts_of(weights: list[float]) -> list[int]:
    """Weights as whole parts of 2**PARTS_BITS; none without a part, the largest takes what rounding leaves."""
    total = 1 << PARTS_BITS
    out = [max(1, round(w / math.fsum(weights) * total)) for w in weights]
    out[out.index(max(out))] += total - sum(out)
    return out


def had(parts: list[int], m: int, period: int) -> list[int]:
    """Units of every stream in the first m periods."""
    ends = [0]
    for p in parts:
        ends.append(ends[-1] + p)
    done = [m * period * e >> PARTS_BITS for e in ends]
    return [b - a for a, b in zip(done, done[1:], strict=False)]


def had_column(parts: list[int], m: Column, period: int) -> Column:
    """``had`` as an array column of the column m."""
    done, end = [F.lit(0).cast("long")], 0
    for p in parts:
        end += p
        whole, rest = divmod(period * end, 1 << PARTS_BITS)
        done.append(m * whole + F.shiftright(m * rest, PARTS_BITS))
    return F.array(*(b - a for a, b in zip(done, done[1:], strict=False)))


def periods(parts: list[int], units: list[int], period: int) -> int:
    """How many whole periods the streams' units are enough for."""

    def enough(m: int) -> bool:
        return all(h <= u for h, u in zip(had(parts, m, period), units, strict=True))

    lo, hi = 0, 1
    while enough(hi):
        lo, hi = hi, 2 * hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if enough(mid) else (lo, mid)
    return lo


def schedule(spark: SparkSession, parts: list[int], n: int, period: int = PERIOD) -> DataFrame:
    """(stream, unit, slot, release, due) of the first n periods: earliest deadline first among released units, the first stream on ties."""
    m = F.col("id")
    rows = spark.range(0, n, 1, max(1, min(n, 4 * spark.sparkContext.defaultParallelism))).select(m.alias("m"), had_column(parts, m, period).alias("before"), had_column(parts, m + 1, period).alias("after"))
    rows = rows.select("m", "before", F.zip_with("before", "after", lambda a, b: (b - a).cast("int")).alias("q"))
    start = F.struct(F.transform("q", lambda _: F.lit(0)).alias("done"), F.array().cast("array<struct<stream:int,k:int,t:int>>").alias("out"))
    streams = F.sequence(F.lit(0), F.lit(len(parts) - 1))
    share = lambda i: F.element_at("q", i + 1)
    release = lambda k, i: F.floor(k * period / share(i)).cast("int")
    due = lambda k, i: F.ceil((k + 1) * period / share(i)).cast("int")

    def step(state, t):
        done = lambda i: F.element_at(state["done"], i + 1)
        ready = F.filter(streams, lambda i: (done(i) < share(i)) & (release(done(i), i) <= t))
        best = F.array_min(F.transform(ready, lambda i: F.struct(due(done(i), i).alias("due"), i.alias("stream"))))["stream"]
        return F.struct(
            F.transform(state["done"], lambda d, i: d + (i == best).cast("int")).alias("done"),
            F.concat(state["out"], F.array(F.struct(best.alias("stream"), done(best).alias("k"), t.alias("t")))).alias("out"),
        )

    fold = F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, step)
    each = rows.select("m", "before", "q", F.inline(fold["out"]))
    at = lambda c: (F.col("m") * period + c).cast("long")
    return each.select("stream", (F.element_at("before", F.col("stream") + 1) + F.col("k")).alias("unit"), at(F.col("t")).alias("slot"), at(release(F.col("k"), F.col("stream"))).alias("release"), at(due(F.col("k"), F.col("stream"))).alias("due"))


def sized(docs: DataFrame, *others: Column) -> DataFrame:
    """(doc_id, source, size, print) of every row: bytes with a header, and a hash that tells texts of one doc_id apart."""
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + 16).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("print"), *others)


def named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_null": F.col("source").isNull(), "_name": F.coalesce(F.col("source").cast("string"), F.lit(""))})


def before(rows: DataFrame, group: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """Bytes before every row of its group, by bucket and then ``order``."""
    keys = [*group, bucket]
    own = F.coalesce(F.sum("size").over(W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    w = (W.partitionBy(*group) if group else W.partitionBy(F.lit(0))).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    # a row per bucket: as many as a source's rows have a square root, or some 256 for each doubling of a position
    totals = rows.groupBy(*keys).agg(F.sum("size").alias("_sum")).withColumn("_base", F.coalesce(F.sum("_sum").over(w), F.lit(0))).drop("_sum")
    return rows.withColumn("_own", own).join(totals, keys).withColumn(name, F.col("_own") + F.col("_base")).drop("_own", "_base", bucket)


def by_source(spark: SparkSession, values: list[tuple], name: str, kind: pa.DataType) -> DataFrame:
    """(SOURCE, name) of (is null, source, value); made from Arrow, as tuples would go through Python workers, which then stay."""
    columns = list(zip(*values, strict=True)) or [(), (), ()]
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, (pa.bool_(), pa.string(), kind), strict=True)], [*SOURCE, name]))


def targets(rows: DataFrame, weights: dict | None, power: float) -> DataFrame:
    """(SOURCE, bytes, rows, weight): a row per source, weights adding up to 1; a written table."""
    stats = store.keep(named(rows).groupBy(*SOURCE).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "mx-sources")
    if weights is None:
        goal = stats.withColumn("goal", F.pow(F.col("bytes").cast("double"), F.lit(power)))
    else:
        if any(not math.isfinite(w) or w < 0 for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        given = by_source(rows.sparkSession, [(s is None, s or "", float(w)) for s, w in weights.items()], "goal", pa.float64())
        goal = stats.join(given, SOURCE, "left").withColumn("goal", F.coalesce("goal", F.lit(0.0)))
    total = goal.agg(F.sum("goal")).first()[0]
    if total is not None and not total > 0:
        raise ValueError("no source has a positive weight")
    return store.keep(goal.select(*SOURCE, "bytes", "rows", (F.col("goal") / F.lit(total or 1.0)).alias("weight")), "mx-targets")


def place(rows: DataFrame, whole: DataFrame, weights: dict | None = None, period: int = PERIOD, block_bytes: int = BLOCK_BYTES, power: float = POWER) -> DataFrame:
    """The columns of ``mix`` for the rows of ``whole``, and its columns beyond those of ``rows``; ``rows`` are the same rows as ``sized`` gives them."""
    spark, unit = rows.sparkSession, block_bytes // 2
    others = [c for c in whole.columns if c not in rows.columns]
    columns = ["doc_id", "source", "size", "block", "target", "release", "due", "slot", "in_mix", *others]
    goal = targets(rows, weights, power)
    large = goal.where(F.col("weight") * period >= 2)
    # sources with a stream of their own: period / 2 at most
    own = large.orderBy(F.desc("weight"), *SOURCE).collect()
    rest = goal.where((F.col("weight") > 0) & (F.col("weight") * period < 2)).agg(F.sum("weight").alias("w"), F.min(F.col("bytes") / F.col("weight")).alias("end")).first()
    if not own and rest.w is None:
        return whole.select("doc_id", "source", "size", *(F.lit(None).cast(t).alias(c) for c, t in zip(columns[3:8], ("long", "double", "long", "long", "long"), strict=True)), F.lit(False).alias("in_mix"), *others)
    # the shared stream comes first: its count of units then never falls
    parts = parts_of([*([] if rest.w is None else [rest.w]), *(r.weight for r in own)])
    first = int(rest.w is not None)
    streams = by_source(spark, [(r["_null"], r["_name"], i + first) for i, r in enumerate(own)], "_stream", pa.int32())
    table = store.keep(goal.join(F.broadcast(streams), SOURCE, "left").select(*SOURCE, "weight", F.coalesce("_stream", F.when(F.col("weight") > 0, 0), F.lit(-1)).alias("stream"), F.ceil(F.sqrt("rows")).cast("long").alias("_buckets")), "mx-streams")
    hot = skew.hot_of(goal, SOURCE)

    def dealt(some: DataFrame) -> DataFrame:
        """With stream and position: bytes before a document in its stream."""
        known = skew.look_up(named(some), table, SOURCE, hot).withColumn("_b", F.pmod(F.xxhash64("doc_id", "print", F.lit("mix")), F.col("_buckets")))
        known = before(known, SOURCE, "_b", ["doc_id", "size", "print"], "position").drop("_buckets")
        if not first:
            return known
        # null and repeated doc_ids are dealt out by their texts
        # somewhere within the document, by hash of its source: else all sources would begin at once
        within = F.pmod(F.xxhash64(*SOURCE), F.lit(1_000)) / 1_000 * F.col("size")
        shared = known.where("stream = 0").withColumn("_x", (F.col("position") + within) / F.col("weight"))
        shared = before(shared.withColumn("_b", F.floor(256 * F.log2(1 + F.col("_x"))).cast("int")).drop("position"), [], "_b", ["_x", "doc_id", "size", "print"], "position")
        return known.where("stream <> 0").withColumn("_x", F.lit(None).cast("double")).unionByName(shared)

    units = [-(-r.bytes // unit) for r in own]
    if first:
        until = dealt(rows).where(F.col("_x") < rest.end).agg(F.sum("size")).first()[0] or 0
        units.insert(0, -(-until // unit))
    n = periods(parts, units, period)
    plan = store.keep(schedule(spark, parts, n + 1, period), "mx-plan")
    # the last period: ``period`` rows
    slots = {(r.stream, r.unit): r.slot for r in plan.where(F.col("slot") >= n * period).collect()}
    end = min(slots[i, u] for i, u in enumerate(units) if (i, u) in slots)
    pace = F.element_at(F.array(*(F.lit((1 << PARTS_BITS) / p) for p in parts)), F.col("stream") + 1)
    later = F.greatest(F.lit((n + 1) * period), F.floor(F.col("unit") * pace))
    placed = dealt(whole).withColumn("unit", F.floor(F.col("position") / unit)).join(plan, ["stream", "unit"], "left")
    slot = F.when(F.col("stream") >= 0, F.coalesce("slot", later))
    return placed.select("doc_id", "source", "size", F.floor(F.col("position") / block_bytes).alias("block"), F.col("weight").alias("target"), "release", "due", slot.alias("slot"), F.coalesce(slot < end, F.lit(False)).alias("in_mix"), *others)


def mix(docs: DataFrame, weights: dict | None = None, period: int = PERIOD, block_bytes: int = BLOCK_BYTES, power: float = POWER) -> DataFrame:
    """(doc_id, source, size, block, target, release, due, slot, in_mix) of every row.

    ``weights`` by source, else in proportion to bytes**power: below 1, large sources are held back.
    """
    rows = store.keep(sized(docs), "mx-rows")
    return place(rows, rows, weights, period, block_bytes, power)


def blend(docs: DataFrame, **options) -> DataFrame:
    """Every document with all its columns, in the order of the slots over the output files; those without a slot come last.

    The columns travel with their row, so rows of null or repeated doc_ids are written like any other. ``docs`` is
    read several times: a table, not a sample drawn anew each time.
    """
    rows = store.keep(sized(docs), "mx-rows")
    row = store.fresh("_row", ["doc_id", "source", "size", "print"])
    got = place(rows, sized(docs, F.struct("*").alias(row)), **options)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc_nulls_last("slot"), "doc_id", F.xxhash64(f"{row}.text")]
    return got.repartitionByRange(n, *order).sortWithinPartitions(*order).select(f"{row}.*")
