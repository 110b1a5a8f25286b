"""Products as vectors, and their clusters."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from demandspark.functions import scalars as S
from demandspark.operators import rules
from demandspark.schema import PRODUCT_KEYS
from demandspark.sources.scratch import keep


def sku_dimension(panel: DataFrame) -> DataFrame:
    """One row per product with totals and price (null without units)."""
    grouped = panel.dropna(subset=PRODUCT_KEYS).groupBy(*PRODUCT_KEYS).agg(S.total(F.col("sales")).alias("sales"), S.total(F.col("units")).alias("units"))
    return grouped.withColumn("price", F.when(F.col("units") != 0, F.try_divide("sales", "units")))


def repeated_skus(dimension: DataFrame) -> DataFrame:
    return dimension.groupBy("sku").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def one_row_per_sku(dimension: DataFrame) -> DataFrame:
    """The same rows, or ValueError if a sku has several sets of attributes. Runs one small job."""
    if bad := [r.sku for r in repeated_skus(dimension).limit(5).collect()]:
        raise ValueError(f"several rows for skus {bad}")
    return dimension


def extent(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: smallest and largest value of every column, as min_<column> and max_<column>."""
    return df.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)))


def price_range(dimension: DataFrame, cell: int = 50, neighbours: int = 2) -> DataFrame:
    """One row: lower end of the price cells and their number, with ``neighbours`` spare cells at both ends."""
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    row = extent(dimension, ["price"]).select(at("min_price").alias("_lo"), at("max_price").alias("_hi"))
    return row.select(((F.col("_lo") - neighbours) * cell).alias("low"), (F.col("_hi") - F.col("_lo") + 2 * neighbours + 1).alias("cells"))


def with_price_cells(dimension: DataFrame, cell: int = 50, neighbours: int = 2, weights: Iterable[float] = (1.0, 0.5, 0.25)) -> tuple[DataFrame, int]:
    """The written dimension with ``price_cells``, its entries in the vector of price cells, and how many cells there are. Runs one small job."""
    row = price_range(dimension, cell, neighbours).first()
    cells = int(row.cells or 1)
    return dimension.withColumn("price_cells", S.price_cells(F.col("price"), row.low or 0, cells, cell, neighbours, weights)), cells


def vectors(dimension: DataFrame, cell: int = 50, neighbours: int = 2, weights: Iterable[float] = (1.0, 0.5, 0.25)) -> DataFrame:
    """Adds ``features``: sparse one-hot product, supplier and license next to the price vector."""
    columns = ["product", "supplier", "license"]
    coded = [f"{c}_code" for c in columns]
    steps = [
        StringIndexer(inputCols=columns, outputCols=[f"{c}_index" for c in columns], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=coded, dropLast=False),
        VectorAssembler(inputCols=[*coded, "_price"], outputCol="features"),
    ]
    priced, cells = with_price_cells(dimension, cell, neighbours, weights)
    priced = priced.withColumn("_price", array_to_vector(S.price_vector(F.col("price_cells"), cells)))
    return Pipeline(stages=steps).fit(priced).transform(priced).select(*dimension.columns, "features")


def split_clusters(df: DataFrame, column: str = "raw_cluster", by: Iterable[str] = ("license", "product"), name: str = "cluster") -> DataFrame:
    """Clusters split by other columns, numbered from 0 in order of (cluster, columns); null where one of them is null.

    The rank is over the distinct keys only and in two levels: within a cluster, and over the clusters' numbers of keys.
    """
    keys = [column, *by]
    distinct = df.select(*keys).dropna().distinct()
    own = distinct.withColumn("_rank", F.row_number().over(W.partitionBy(column).orderBy(*by)))
    # a row per cluster: as many as k-means was asked for
    before = distinct.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy(column).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    numbered = own.join(before.drop("_n"), column).select(*keys, (F.col("_rank") + F.col("_before") - 1).cast("int").alias(name))
    return df.join(numbered, keys, "left")


def assign(dimension: DataFrame, clusters: int = 200, cell: int = 50, neighbours: int = 2, weights: Iterable[float] = (1.0, 0.5, 0.25), labels=None, synonyms=None, seed: int = 0) -> DataFrame:
    """(sku, license, product, cluster) of every product of the dimension; warns if there are fewer skus than clusters, of which each then is one.

    The dimension is written first, as several passes read it, and so are the raw clusters.
    """
    dimension = one_row_per_sku(keep(dimension, "dimension"))
    labelled = rules.with_product(dimension, labels, synonyms) if labels else rules.with_product(dimension)
    v = vectors(labelled, cell, neighbours, weights).persist()
    try:
        found = v.count()
        if found < clusters:
            warnings.warn(f"{found} products make no {clusters} clusters", RuntimeWarning, stacklevel=3)
        model = KMeans(k=max(2, min(clusters, found)), seed=seed, featuresCol="features", predictionCol="raw_cluster").fit(v)
        raw = keep(model.transform(v).select("sku", "license", "product", "raw_cluster"), "raw-clusters")
    finally:
        v.unpersist()
    return split_clusters(raw).select("sku", "license", "product", "cluster")


def categorize(panel: DataFrame, clusters: int = 200, cell: int = 50, neighbours: int = 2, weights: Iterable[float] = (1.0, 0.5, 0.25), labels=None, synonyms=None, seed: int = 0) -> DataFrame:
    """The panel with product and cluster of every sku."""
    found = assign(sku_dimension(panel), clusters, cell, neighbours, weights, labels, synonyms, seed)
    return panel.join(found.drop("license"), "sku", "left")
