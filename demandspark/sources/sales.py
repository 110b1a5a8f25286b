"""Readers and writers of the jobs, and the driver's tables as sale lines."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.schema import HEADINGS, MONTHS, SALES


def named(raw: DataFrame, headings: dict[str, str] | None = None) -> DataFrame:
    """The sale columns of a table, found by our name or by heading, whatever their order and case; other columns are left out.

    ValueError if one is missing, or if two columns claim one name.
    """
    ours = {x.lower(): y for x, y in (HEADINGS if headings is None else headings).items()} | {f.name.lower(): f.name for f in SALES}
    found: dict[str, list[str]] = {}
    for c in raw.columns:
        if (name := ours.get(c.strip().lower())) is not None:
            found.setdefault(name, []).append(c)
    if missing := [f.name for f in SALES if f.name not in found]:
        raise ValueError(f"columns missing in the sale lines: {missing}")
    if several := {k: v for k, v in found.items() if len(v) > 1}:
        raise ValueError(f"several columns for one of the sale lines: {several}")
    return raw.select(*(F.col(f"`{found[f.name][0]}`").alias(f.name) for f in SALES))


def read_sales_checked(spark: SparkSession, path: str, form: str = "parquet", headings: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(sale lines, rejected lines as text with ``bad``, the names of columns whose text is no number).

    Columns are bound by heading. CSV files are read as text first; files of one folder must have the same headings in the
    same order, which is checked. Empty cells are nulls, not bad numbers. NaN is null.
    """
    if form == "csv":
        names = spark.read.option("header", True).csv(path).columns
        text = T.StructType([T.StructField(c, T.StringType()) for c in names])
        raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    else:
        raw = spark.read.format(form).load(path)
    raw = named(raw, headings)
    typed = {f.name: raw[f.name].try_cast(f.dataType) for f in SALES}
    numbers = [f.name for f in SALES if not isinstance(f.dataType, T.StringType)]
    bad = F.array_compact(F.array(*(F.when(raw[c].isNotNull() & typed[c].isNull(), F.lit(c)) for c in numbers)))
    marked = raw.withColumn("bad", bad)
    real = {f.name: F.nanvl(typed[f.name], F.lit(None).cast("double")) if isinstance(f.dataType, T.DoubleType) else typed[f.name] for f in SALES}
    good = marked.where(F.size("bad") == 0).select(*(real[f.name].alias(f.name) for f in SALES))
    return good, marked.where(F.size("bad") > 0).select(*(F.col(f.name).cast("string").alias(f.name) for f in SALES), "bad")


def read_sales(spark: SparkSession, path: str, form: str = "parquet", headings: dict[str, str] | None = None) -> DataFrame:
    """Sale lines in the declared schema, bound by heading; lines with bad numbers are left out (``read_sales_checked`` has them)."""
    return read_sales_checked(spark, path, form, headings)[0]


def read_interest(spark: SparkSession, path: str) -> DataFrame:
    """Wide monthly index: ``license`` and a double column per month, in the order of the header."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField("license", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in names[1:])])
    return spark.read.schema(schema).option("header", True).csv(path)


def read_titles(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Title attributes as text, but for the three numbers."""
    got = spark.read.option("header", True).option("encoding", encoding).csv(path)
    return got.withColumns({c: F.col(c).try_cast("double") for c in ("budget", "news_articles", "opening_weekend") if c in got.columns})


STAGE_KEYS, LAYOUT = ["level", "series_id"], "_layout"


def write_stage(df: DataFrame, path: str, buckets: int | None = None) -> None:
    """Parquet in buckets by level and series, in order of month within a file, with its schema beside it.

    Jobs that read it find each series whole in a bucket, so their windows by series need no exchange. The path is overwritten.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"stage_{uuid.uuid4().hex}"
    # one file a bucket, as the exchange deals rows out as the buckets do
    dealt = df.repartition(n, *STAGE_KEYS)
    dealt.write.mode("overwrite").bucketBy(n, *STAGE_KEYS).sortBy(*STAGE_KEYS, "date").option("path", path).saveAsTable(name)
    spark.createDataFrame([(name, n, df.schema.json())], "name string, buckets int, schema string").coalesce(1).write.mode("overwrite").json(f"{path}/{LAYOUT}")


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage table with its buckets, in this or any later session; ValueError if not all files have the schema that it was written with.

    Spark reads the footers of all files for that; there are as many files as buckets.
    """
    row = spark.read.schema("name string, buckets int, schema string").json(f"{path}/{LAYOUT}").first()
    schema = T.StructType.fromJson(json.loads(row.schema))
    kinds = lambda s: {f.name: f.dataType.simpleString() for f in s}
    try:
        there = kinds(spark.read.option("mergeSchema", True).parquet(path).schema)
    except (PySparkException, Py4JJavaError) as e:  # files of types that do not go together
        raise ValueError(f"{path} has another schema than it was written with: {e}") from e
    if there != kinds(schema):
        raise ValueError(f"{path} has another schema than it was written with: {sorted(set(there.items()) ^ set(kinds(schema).items()))}")
    if not spark.catalog.tableExists(row.name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(STAGE_KEYS)
        spark.sql(f"CREATE TABLE {row.name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}, date) INTO {row.buckets} BUCKETS LOCATION '{path}'")
    return spark.table(row.name)


def write_forecast(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def _measures() -> list:
    month = F.element_at(F.array(*map(F.lit, MONTHS)), F.month("l_shipdate"))
    return [
        month.alias("month_name"), F.year("l_shipdate").alias("year"), F.col("l_quantity").alias("units"), F.col("l_extendedprice").alias("sales"),
        F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity") + 1e-9, 4).alias("cost"),
    ]


def sales_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse sale lines: a sku is a part, a platform a return flag."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    joined = _lines(spark, sf_dir).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("description"), F.col("p_brand").alias("supplier"), F.col("p_type").alias("license"), F.col("l_returnflag").alias("platform"), *_measures())


def sales_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense sale lines: a sku is a supplier, a platform a line status."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    dim = read("supplier").join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = _lines(spark, sf_dir).join(dim, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(F.col("s_suppkey").cast("string").alias("sku"), F.col("s_name").alias("description"), F.col("n_name").alias("supplier"), F.col("r_name").alias("license"), F.col("l_linestatus").alias("platform"), *_measures())


def interest_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide interest index: lines of each part type in every month of the table."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    lines = _lines(spark, sf_dir)
    month = F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1
    lo, hi = lines.agg(F.min(month), F.max(month)).first()
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("p_type").alias("license"), month.alias("month"))
    # a column per month, as the index is delivered
    columns = [F.count_if(F.col("month") == m).cast("double").alias(f"m{m // 12}_{m % 12 + 1:02d}") for m in range(lo or 0, (hi or 0) + 1)]
    return joined.groupBy("license").agg(*columns)


def titles_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title attributes of each part type, made of its parts' figures."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    by = part.groupBy(F.col("p_type").alias("license")).agg(F.count(F.lit(1)).alias("n"), F.max("p_size").alias("size"), F.round(F.avg("p_retailprice"), 2).alias("budget"))
    return by.select(
        "license", F.concat(F.col("n").cast("string"), F.lit(" min")).alias("run_time"), F.concat(F.round(F.col("size") / 10, 1).cast("string"), F.lit("/10")).alias("imdb_rating"),
        F.when(F.col("n") % 2 == 0, F.lit("soon")).alias("next release"), F.when(F.col("license") < "M", F.lit("North Co.")).when(F.col("license") < "S", F.lit("South Co.")).alias("production_company"),
        F.concat_ws("/", (F.col("n") % 12 + 1).cast("string"), F.lit("15"), F.lpad((F.col("n") % 100).cast("string"), 2, "0")).alias("release_date"),
        "budget", F.col("n").cast("double").alias("news_articles"), (F.col("budget") * 2).alias("opening_weekend"), F.lit("released").alias("title_tatus"), F.lit("movie").alias("title_type"),
    )
