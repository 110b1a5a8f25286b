"""Months in which a product was likely out of stock."""

from __future__ import annotations

import math
import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.functions import joins
from demandspark.functions import scalars as S
from demandspark.sources.scratch import keep


def series_window():
    return W.partitionBy("sku_platform").orderBy("date")


def whole_series():
    return W.partitionBy("sku_platform")


def with_price(panel: DataFrame) -> DataFrame:
    """Price = sales / units; where there is none, the series' unit-weighted mean price, by a window that shares the labels' exchange."""
    price = F.try_divide("sales", "units")
    mean = F.try_divide(F.sum(price * F.col("units")).over(whole_series()), F.sum(F.when(price.isNotNull(), F.col("units"))).over(whole_series()))
    return panel.withColumn("price", F.coalesce(price, mean))


def platform_months(panel: DataFrame) -> DataFrame:
    """Units of a platform in a month: very few keys, so an aggregation with a map side and never a window."""
    return panel.groupBy("date", "platform").agg(S.total(F.col("units")).alias("platform_monthly_sales"))


def with_platform_months(panel: DataFrame) -> DataFrame:
    """Adds the units of the row's platform in its month. The totals are written and counted, so the panel stays where it is; it is read twice."""
    return joins.look_up(panel, keep(platform_months(panel), "platform-months"), ["date", "platform"])


def poisson_effects(df: DataFrame, covariates: tuple[str, ...] = ("price", "platform_monthly_sales"), steps: int = 25, tolerance: float = 1e-8) -> tuple[DataFrame, np.ndarray]:
    """Poisson regression with an effect of its own for each series; (rows with ``pred``, slopes of the raw covariates).

    Given the slopes an effect has a closed form, so each Newton step is one aggregation by series and one sum over
    it; only a handful of numbers comes to the driver. Covariates are centred and scaled; a step that does not raise
    the likelihood is halved. Rows without a covariate get no prediction; series without sales get 0. Warns if ``steps``
    end before the slopes stand still. ``df`` is read three times: it is best a table that is written already.
    """
    whole = df.dropna(subset=["units", *covariates])
    stats = whole.agg(*(f(F.col(c)).alias(f"{n}_{c}") for c in covariates for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    center = np.array([stats[f"m_{c}"] or 0.0 for c in covariates])
    scale = np.array([stats[f"s_{c}"] or 1.0 for c in covariates])
    x = [(F.col(c) - float(m)) / float(s) for c, m, s in zip(covariates, center, scale, strict=True)]
    k = len(covariates)
    # written first: what a lost executor held in memory is read again, not worked out from the sale lines
    base = keep(whole.select("sku_platform", F.col("units").alias("y"), *(e.alias(f"x{i}") for i, e in enumerate(x))), "poisson").repartition("sku_platform").persist()

    def moments(beta: np.ndarray):
        eta = sum((F.col(f"x{i}") * float(b) for i, b in enumerate(beta)), F.lit(0.0))
        e = F.exp(eta)
        per = base.groupBy("sku_platform").agg(
            F.sum("y").alias("Y"), F.sum(e).alias("E"), F.sum(F.col("y") * eta).alias("L"), *(F.sum(F.col(f"x{i}") * F.col("y")).alias(f"xy{i}") for i in range(k)),
            *(F.sum(F.col(f"x{i}") * e).alias(f"xe{i}") for i in range(k)), *(F.sum(F.col(f"x{i}") * F.col(f"x{j}") * e).alias(f"xx{i}{j}") for i in range(k) for j in range(i, k)),
        ).where("Y > 0")
        r = F.col("Y") / F.col("E")
        return per.agg(
            F.sum(F.col("L") - F.col("Y") * F.log("E")).alias("likelihood"), *(F.sum(F.col(f"xy{i}") - r * F.col(f"xe{i}")).alias(f"g{i}") for i in range(k)),
            *(F.sum(r * F.col(f"xx{i}{j}") - r * r * F.col(f"xe{i}") * F.col(f"xe{j}") / F.col("Y")).alias(f"h{i}{j}") for i in range(k) for j in range(i, k)),
        ).first()

    beta, at = np.zeros(k), None
    try:
        at = moments(beta)
        for _ in range(steps):
            if at.likelihood is None:
                break
            g = np.array([at[f"g{i}"] for i in range(k)])
            h = np.array([[at[f"h{min(i, j)}{max(i, j)}"] for j in range(k)] for i in range(k)])
            step = np.linalg.lstsq(h + 1e-12 * np.eye(k), g, rcond=None)[0]
            size = 1.0
            while size > 1e-6:
                new = moments(beta + size * step)
                if math.isfinite(new.likelihood) and new.likelihood >= at.likelihood - 1e-12 * abs(at.likelihood):
                    break
                size /= 2
            else:
                break
            gain = new.likelihood - at.likelihood
            beta, at = beta + size * step, new
            if gain <= tolerance * (1 + abs(at.likelihood)) and np.abs(size * step).max() < 1e-7:
                break
        else:
            warnings.warn(f"the Poisson fit did not settle in {steps} steps", RuntimeWarning, stacklevel=2)
    finally:
        base.unpersist()
    e = F.exp(sum((c * float(b) for c, b in zip(x, beta, strict=True)), F.lit(0.0)))
    real = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in ("units", *covariates)))
    effect = F.try_divide(F.sum(F.when(real, F.col("units"))).over(whole_series()), F.sum(F.when(real, e)).over(whole_series()))
    return df.withColumn("pred", effect * e), beta / scale


def fit_numbers() -> list[Column]:
    """Number of rows with ``pred``, and root of its mean squared error."""
    real = F.col("pred").isNotNull()
    return [F.count_if(real).alias("n_rows"), F.sqrt(F.avg(F.when(real, F.pow(F.col("units") - F.col("pred"), 2)))).alias("rmse")]


def fit_report(df: DataFrame) -> DataFrame:
    return df.agg(*fit_numbers())


def residuals(df: DataFrame) -> DataFrame:
    return df.withColumn("residuals", S.pearson_residual(F.col("units"), F.col("pred")))


def seeds(df: DataFrame, surge: float = 1.25, at_zero: float = 1.0, second_point: float = 10.0, at_second: float = 2.0) -> DataFrame:
    """Adds is_first, surge, slump and seed: a slump next to a surge, or in the series' first month."""
    slope = -(at_second - at_zero) / math.log(1 + second_point)
    r = F.coalesce("residuals", F.lit(0.0))
    flags = df.withColumn("surge", (r > surge).cast("int")).withColumn("slump", (r < slope * F.log1p("units") - at_zero).cast("int"))
    near = (F.lag("surge", 1, 0).over(series_window()) == 1) | (F.lead("surge", 1, 0).over(series_window()) == 1)
    return flags.withColumn("is_first", F.row_number().over(series_window()) == 1).withColumn("seed", ((F.col("slump") == 1) & (near | F.col("is_first"))).cast("int"))


def spread(df: DataFrame) -> DataFrame:
    """Adds stockout: a seed takes its whole stretch of slumps; a stretch of one row counts only at the series' start.

    Stretches are numbered by a running count of changes, so no pass per month is needed; all windows share one sort.
    """
    change = (F.col("slump") != F.lag("slump").over(series_window())).cast("int")
    numbered = df.withColumn("_c", F.coalesce(change, F.lit(0))).withColumn("_island", F.sum("_c").over(series_window().rowsBetween(W.unboundedPreceding, 0)))
    island = W.partitionBy("sku_platform", "_island")
    hit = (F.col("slump") == 1) & (F.max("seed").over(island) == 1) & ((F.count(F.lit(1)).over(island) >= 2) | F.col("is_first"))
    return numbered.withColumn("stockout", hit.cast("int")).drop("_c", "_island")


def label(df: DataFrame, surge: float = 1.25, at_zero: float = 1.0, second_point: float = 10.0, at_second: float = 2.0) -> DataFrame:
    """Rows with ``pred`` to rows with ``residuals`` and ``stockout``."""
    return spread(seeds(residuals(df), surge, at_zero, second_point, at_second))


def label_numbers() -> list[Column]:
    """Numbers of rows, seeds and final stock-outs."""
    return [F.count(F.lit(1)).alias("n_rows"), F.sum("seed").alias("seeds"), F.sum("stockout").alias("stockouts")]


def counts(labelled: DataFrame) -> DataFrame:
    return labelled.agg(*label_numbers())


def drop_stockouts(df: DataFrame) -> DataFrame:
    """Rows in stock; without a label nothing goes."""
    have = df if "stockout" in df.columns else df.withColumn("stockout", F.lit(0))
    return have.where("stockout = 0")
