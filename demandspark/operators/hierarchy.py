"""Roll-up of series to the levels above them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.functions import scalars as S
from demandspark.sources.scratch import keep


def tag_bottom(panel: DataFrame) -> DataFrame:
    return panel.withColumn("count", F.lit(1).cast("long")).withColumn("level", F.lit("bottom")).withColumn("series_id", F.col("sku_platform"))


def edges(panel: DataFrame, levels: Iterable[str]) -> DataFrame:
    """(level, parent_id, child_id): which series stand beneath which parent; each bottom series beneath itself."""
    out = panel.select(F.lit("bottom").alias("level"), F.col("sku_platform").alias("parent_id"), F.col("sku_platform").alias("child_id"))
    for level in levels:
        out = out.unionByName(panel.select(F.lit(level).alias("level"), F.col(level).cast("string").alias("parent_id"), F.col("sku_platform").alias("child_id")))
    return out.dropna().distinct()


def rollup(panel: DataFrame, level: str, values: Iterable[str] = ("units", "sales")) -> DataFrame:
    """Totals and number of rows by parent and month. One aggregation with a map side: few and uneven parents do no harm."""
    return panel.where(F.col(level).isNotNull()).groupBy(level, "date").agg(*(S.total(F.col(v)).alias(v) for v in values), F.count(F.lit(1)).alias("count"))


def rollup_by_edges(panel: DataFrame, level: str, values: Iterable[str] = ("units", "sales")) -> DataFrame:
    """As ``rollup`` where a series can have several parents over time: it counts in all of them in every month."""
    own = edges(panel, [level]).where(F.col("level") == level).select("parent_id", F.col("child_id").alias("sku_platform"))
    alive = panel.where(F.col(level).isNotNull()).groupBy(F.col(level).cast("string").alias("parent_id"), "date").agg(F.count(F.lit(1)).alias("count"))
    sums = own.join(panel, "sku_platform").groupBy("parent_id", "date").agg(*(S.total(F.col(v)).alias(v) for v in values))
    return sums.join(alive, ["parent_id", "date"]).withColumnRenamed("parent_id", level)


def mean_by_parent(panel: DataFrame, level: str, column: str = "cost") -> DataFrame:
    """Unit-weighted mean of a column by parent, over all months."""
    return panel.where(F.col(level).isNotNull()).groupBy(level).agg(S.weighted_mean(F.col(column), F.col("units")).alias(column))


def single_valued(panel: DataFrame, level: str, columns: Iterable[str]) -> DataFrame:
    """One row: for every column, whether each parent has exactly one non-null value of it."""
    columns = [c for c in columns if c != level]
    per = panel.where(F.col(level).isNotNull()).groupBy(level).agg(*(F.min(c).alias(f"lo_{c}") for c in columns), *(F.max(c).alias(f"hi_{c}") for c in columns))
    return per.agg(*(F.coalesce(F.every(F.coalesce(F.col(f"lo_{c}") == F.col(f"hi_{c}"), F.lit(False))), F.lit(False)).alias(c) for c in columns))


def levels_above(panel: DataFrame, levels: Iterable[str], values: Iterable[str], categories: Iterable[str], averages: Iterable[str]) -> DataFrame:
    """Rows of all levels in one pass: (level, series_id, date, the levels, values, count, averages, lo_ and hi_ of each category).

    Grouping sets roll the panel up to every (parent, month) in one scan with a map side; what holds for a parent in all its
    months (means, smallest and largest attribute) is a window over those few rows. Rows without a parent of a level do not
    count in it.
    """
    levels, values, categories, averages = list(levels), list(values), list(categories), list(averages)
    own = panel.select(*levels, "date", *(F.col(v).alias(f"_v_{v}") for v in values), F.col("units").alias("_units"), *(F.col(c).alias(f"_a_{c}") for c in averages), *(F.col(c).alias(f"_c_{c}") for c in categories))
    weights = [x for c in averages for x in (F.sum(F.col(f"_a_{c}") * F.col("_units")).alias(f"_s_{c}"), F.sum(F.when(F.col(f"_a_{c}").isNotNull(), F.col("_units"))).alias(f"_w_{c}"))]
    ends = [x for c in categories for x in (F.min(f"_c_{c}").alias(f"_lo_{c}"), F.max(f"_c_{c}").alias(f"_hi_{c}"))]
    in_set = {x: F.grouping(x) == 0 for x in levels}
    name = F.coalesce(*(F.when(on, F.lit(x)) for x, on in in_set.items())).alias("level")
    node = F.coalesce(*(F.when(on, F.col(x).cast("string")) for x, on in in_set.items())).alias("series_id")
    rolled = own.groupingSets([[x, "date"] for x in levels], *levels, "date").agg(name, node, *(S.total(F.col(f"_v_{v}")).alias(v) for v in values), F.count(F.lit(1)).alias("count"), *weights, *ends).where("series_id is not null")
    w = W.partitionBy("level", "series_id")
    means = [F.try_divide(F.sum(f"_s_{c}").over(w), F.sum(f"_w_{c}").over(w)).alias(c) for c in averages]
    attributes = [x for c in categories for x in (F.min(f"_lo_{c}").over(w).alias(f"lo_{c}"), F.max(f"_hi_{c}").over(w).alias(f"hi_{c}"))]
    return rolled.select("level", "series_id", "date", *levels, *values, "count", *means, *attributes)


def stack(panel: DataFrame, levels: Iterable[str] = ("cluster", "license"), values: Iterable[str] = ("units", "sales"), categories: Iterable[str] = ("supplier", "license", "product"), averages: Iterable[str] = ("cost",), kept: dict[str, list[str]] | None = None) -> DataFrame:
    """All levels below each other; columns that a level lacks are null.

    ``kept`` says which attributes every level keeps, as they have one value in each parent; else the rows above the bottom are
    written and one small job over them finds out.
    """
    levels, categories = list(levels), list(categories)
    if not levels:
        return tag_bottom(panel)
    above = levels_above(panel, levels, values, categories, averages)
    if kept is None:
        above = keep(above, "levels")
        found = above.groupBy("level").agg(*(F.every(F.coalesce(F.col(f"lo_{c}") == F.col(f"hi_{c}"), F.lit(False))).alias(c) for c in categories)).collect()
        kept = {r.level: [c for c in categories if c != r.level and r[c]] for r in found}
    holds = lambda c: F.col("level").isin(*(x for x in levels if c in kept.get(x, [])))
    attributes = {c: F.when(holds(c), F.col(f"hi_{c}")) for c in categories}
    for c in levels:
        # a level's own column, kept where the rows are of it
        attributes[c] = F.coalesce(F.when(F.col("level") == c, F.col(c)), attributes.get(c, F.lit(None)))
    out = above.withColumns(attributes).drop(*(f"{x}_{c}" for c in categories for x in ("lo", "hi")))
    return tag_bottom(panel).unionByName(out, allowMissingColumns=True)


def drop_single_child(df: DataFrame) -> DataFrame:
    """Without aggregate rows of one child; a null count stays."""
    return df.where((F.col("level") == "bottom") | ~F.col("count").eqNullSafe(F.lit(1)))
