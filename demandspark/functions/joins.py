"""Joins with look-up tables, and running sums, where few keys may hold most rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.sources.scratch import drop, keep

#: Rows of a look-up table that are sent to every executor at most; a few MB, as look-up rows are narrow.
BROADCAST_ROWS = 100_000
#: A key with over 1/SHARE of the rows is hot, so there are fewer than SHARE hot keys.
SHARE = 20_000


def look_up(rows: DataFrame, table: DataFrame, keys: Iterable[str], how: str = "left", most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` joined with ``table``, which has one narrow row per key and has been written, so that it can be counted.

    A table of up to ``most`` rows is broadcast: the rows stay where they are. A longer one is shuffled, but for the rows of
    hot keys, which meet a broadcast part of it; so no task gets the rows of a hot key. ``how`` is left, inner, left_semi or left_anti.
    """
    keys = list(keys)
    if table.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(table), keys, how)
    counted = keep(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "look-up")
    total = counted.agg(F.sum("_n")).first()[0] or 0
    hot = keep(counted.where(F.col("_n") * SHARE > total).select(*keys), "hot-keys")
    drop(counted)
    few = F.broadcast(hot)
    warm = rows.join(few, keys, "left_semi").join(F.broadcast(table.join(few, keys, "left_semi")), keys, how)
    return warm.unionByName(rows.join(few, keys, "left_anti").join(table, keys, how))


def running_sums(rows: DataFrame, group: Iterable[str], order: Iterable[str], sums: dict[str, str]) -> DataFrame:
    """Adds for every (value, name) of ``sums`` the sum of the value over the group's rows up to this one in the given order.

    In two levels, as a group may hold most rows: the rows are range-partitioned by group and order and summed within a
    range, and each range starts from the sum of the group's ranges before it. ``order`` has no ties within a group.
    """
    group, order = list(group), list(order)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = keep(rows.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()), "line")
    before = W.partitionBy(*group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # a row per range and group: no more than ranges and groups together
    starts = line.groupBy(*group, "_part").agg(*(F.sum(v).alias(f"_{n}") for v, n in sums.items()))
    starts = keep(starts.select(*group, "_part", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0.0)).alias(f"_{n}") for n in sums.values())), "starts")
    up_to = W.partitionBy("_part", *group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    own = line.withColumns({n: F.sum(v).over(up_to) for v, n in sums.items()})
    return look_up(own, starts, [*group, "_part"], "inner").withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums.values()}).drop("_part", *(f"_{n}" for n in sums.values()))
