"""From sale lines to a gap-free monthly panel."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions import scalars as S
from demandspark.schema import PANEL_KEYS, PRODUCT_KEYS


def keep_listed(sales: DataFrame, platforms: Iterable[str], excluded: Iterable[str]) -> DataFrame:
    """Rows of listed platforms, without excluded suppliers; a null supplier stays. Reaches the scan as pushed filters."""
    return sales.where(F.col("platform").isin(*platforms) & ~F.coalesce(F.col("supplier").isin(*excluded), F.lit(False)))


def monthly(sales: DataFrame) -> DataFrame:
    """Totals and plain mean cost by product, platform and month; rows with a null key vanish."""
    keys = [*PANEL_KEYS, "month_name", "year"]
    return sales.dropna(subset=keys).groupBy(*keys).agg(S.total(F.col("units")).alias("units"), S.total(F.col("sales")).alias("sales"), F.avg("cost").alias("cost"))


def trim_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: S.trim_all(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.StringType)})


def dated(df: DataFrame) -> DataFrame:
    """Month name and year replaced by the month's first day; rows without a valid month go, as no calendar holds them."""
    return df.withColumn("date", S.month_start(F.col("month_name"), F.col("year"))).drop("month_name", "year").where("date is not null")


def ranges(panel: DataFrame, keys: list[str]) -> DataFrame:
    """First and last month of every key."""
    return panel.groupBy(*keys).agg(F.min("date").alias("first"), F.max("date").alias("last"))


def all_pairs(panel: DataFrame) -> DataFrame:
    """Every product range with every platform."""
    # one row per platform: a handful of shops
    platforms = [r.platform for r in panel.select("platform").where("platform is not null").distinct().collect()]
    return ranges(panel, PRODUCT_KEYS).withColumn("platform", F.explode(F.array(*map(F.lit, platforms)).cast("array<string>")))


def month_steps(start: Column, stop: Column) -> Column:
    """Months from start to stop as an array; none if stop is earlier or null."""
    return F.when(start <= stop, F.sequence(start, stop, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def complete(panel: DataFrame, with_platform: bool = True) -> DataFrame:
    """The panel with its missing months as rows of null measures.

    A product, on every platform that it has units on, gets all months from its first to its last (without
    ``with_platform``: from the first to the last on that platform). The panel moves once, by sku; the months
    missing before the first row of a series, and behind each row, are then made in place, so the exploded rows are never
    shuffled or joined. Rows with a null key vanish.
    """
    series, whole = W.partitionBy(*PANEL_KEYS), W.partitionBy(*(PRODUCT_KEYS if with_platform else PANEL_KEYS))
    in_time = series.orderBy("date")
    measures = [c for c in panel.columns if c not in (*PANEL_KEYS, "date")]
    one = F.expr("interval 1 month")
    # a sku has a few rows per month, so none is too large for a task
    rows = panel.dropna(subset=PANEL_KEYS).repartition("sku").withColumns({"_sold": F.count("units").over(series), "_prev": F.lag("date").over(in_time), "_next": F.lead("date").over(in_time)})
    rows = rows.withColumns({"_first": F.min("date").over(whole), "_last": F.max("date").over(whole)})
    if with_platform:
        rows = rows.where("_sold > 0")
    earlier = F.when(F.col("_prev").isNull(), month_steps(F.col("_first"), (F.col("date") - one).cast("date"))).otherwise(F.array().cast("array<date>"))
    after = (F.col("date") + one).cast("date")
    later = month_steps(after, F.coalesce((F.col("_next") - one).cast("date"), F.col("_last")))
    each = rows.withColumn("_month", F.explode(F.concat(F.array("date"), earlier, later)))
    own = F.col("_month") == F.col("date")
    return each.select(*PANEL_KEYS, F.col("_month").alias("date"), *(F.when(own, F.col(c)).alias(c) for c in measures))


def spine(panel: DataFrame, with_platform: bool = True) -> DataFrame:
    """Every month from a product's first to its last, for each platform that it has units on."""
    return complete(panel.groupBy(*PANEL_KEYS, "date").agg(F.max("units").alias("units")), with_platform).drop("units")


def fill(panel: DataFrame) -> DataFrame:
    """Null units become 0, null costs the sku's unit-weighted mean; sales stay as they are. Adds the series key.

    The mean is a window by sku, by which ``complete`` has dealt the rows already; a sku has a few rows per month.
    """
    filled = panel.withColumn("units", F.coalesce("units", F.lit(0.0))).withColumn("sku_platform", S.series_key(F.col("sku"), F.col("platform")))
    of_sku = W.partitionBy("sku")
    mean = F.try_divide(F.sum(F.col("cost") * F.col("units")).over(of_sku), F.sum(F.when(F.col("cost").isNotNull(), F.col("units"))).over(of_sku))
    return filled.withColumn("cost", F.coalesce("cost", mean))


def null_numbers(columns: Iterable[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def nulls(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: how many nulls each column has."""
    return df.agg(*null_numbers(columns))


def without_nulls(found: dict[str, int]) -> None:
    """ValueError if a required column has nulls."""
    if bad := {k: v for k, v in found.items() if v}:
        raise ValueError(f"nulls in required columns: {bad}")


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The same rows, or ValueError if a required column has nulls. Runs one small job; jobs observe the nulls on a write instead."""
    without_nulls(nulls(df, columns).first().asDict())
    return df


def sku_units(panel: DataFrame) -> DataFrame:
    return panel.groupBy("sku").agg(S.total(F.col("units")).alias("units"))


def significant(panel: DataFrame, least: float, mode: str = "above") -> DataFrame:
    """Rows of skus whose total units exceed ``least``.

    ``mode='exact'`` does what a search for the first total that equals ``least`` does: without such a total
    nothing is kept.
    """
    totals = sku_units(panel)
    keep = totals.where(F.col("units") > least)
    if mode == "exact":
        keep = keep.join(totals.where(F.col("units") == least).select("units").limit(1).select(F.lit(1).alias("_hit")), how="left_semi")
    return panel.join(keep.select("sku"), "sku", "left_semi")


def pareto(panel: DataFrame, least: float) -> DataFrame:
    """One row: share of skus, of rows kept and of units up to the first sku at ``least`` (the first sku if there is none).

    Made of sums over per-sku totals; nothing is ranked in one task.
    """
    totals = sku_units(panel)
    hit = F.max(F.when(F.col("units") == least, 1).otherwise(0)) == 1
    best = F.max("units")
    above = F.col("units") > least
    s = totals.agg(hit.alias("hit"), best.alias("best"), F.count(F.lit(1)).alias("skus"), F.sum("units").alias("units"), F.count_if(above).alias("n_above"), F.coalesce(F.sum(F.when(above, F.col("units"))), F.lit(0.0)).alias("u_above"))
    # rows kept: those of skus above, if some total hits
    per_row = panel.groupBy("sku").agg(S.total(F.col("units")).alias("units"), F.count(F.lit(1)).alias("n"))
    rows = per_row.agg(F.sum("n").alias("n_rows"), F.sum(F.when(above, F.col("n")).otherwise(0)).alias("kept"))
    return s.join(F.broadcast(rows)).select(  # two single rows
        (F.when(F.col("hit"), F.col("n_above") + 1).otherwise(1) / F.col("skus")).alias("sku_share"),
        (F.when(F.col("hit"), F.col("kept")).otherwise(0) / F.col("n_rows")).alias("row_share"),
        (F.when(F.col("hit"), F.col("u_above") + least).otherwise(F.col("best")) / F.col("units")).alias("unit_share"),
    )


def running_share(panel: DataFrame) -> DataFrame:
    """(sku, units, rank, share): running share of units by falling totals, ties by sku.

    The running sum is made in two levels: within ranges of totals, then over the few range sums.
    """
    totals = sku_units(panel)
    step = F.floor(F.log2(F.greatest(F.col("units"), F.lit(1.0))) * 16).cast("int")
    cut = totals.withColumn("_b", -step)
    w = W.partitionBy("_b").orderBy(F.desc("units"), "sku").rowsBetween(W.unboundedPreceding, 0)
    own = cut.withColumn("_run", F.sum("units").over(w)).withColumn("_rank", F.row_number().over(W.partitionBy("_b").orderBy(F.desc("units"), "sku")))
    # at most 16 ranges for each doubling of the totals: a few thousand rows
    over = W.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    before = cut.groupBy("_b").agg(F.sum("units").alias("_u"), F.count(F.lit(1)).alias("_n")).select("_b", F.coalesce(F.sum("_u").over(over), F.lit(0.0)).alias("_u0"), F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_n0"), F.sum("_u").over(W.partitionBy(F.lit(0))).alias("_all"))
    joined = own.join(F.broadcast(before), "_b")
    return joined.select("sku", "units", (F.col("_rank") + F.col("_n0")).cast("long").alias("rank"), ((F.col("_run") + F.col("_u0")) / F.col("_all")).alias("share"))
