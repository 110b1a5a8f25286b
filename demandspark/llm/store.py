"""Tables between the steps of an operator, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_PATHS: dict[int, tuple[DataFrame, str]] = {}


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a temporary folder, which only a local master can share."""
    got = spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        got = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


def keep(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write a table and read it again: cuts the lineage, and a lost executor costs nothing that is already written.

    ``batch_rows`` bounds the rows handed to Python at once while it is made, for steps with heavy rows.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(BATCH)
    try:
        if batch_rows:
            spark.conf.set(BATCH, str(batch_rows))
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH, was)
    got = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(got)] = got, path
    return got


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``keep`` gave and that no later step reads any more."""
    for df in tables:
        _, path = _PATHS.pop(id(df))
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """With a column ``name`` that sorts the rows as they were written: by number of the Parquet file, then by row in it.

    Spark reads the files of a table by size, so the order of the rows that it reads is not that of the table. Rows that
    come from no Parquet file stand as their partitions do.
    """
    try:
        at = df.metadataColumn("_metadata")
        number = F.regexp_extract(at["file_name"], r"(\d+)", 1).try_cast("long")
        return df.withColumn(name, F.struct(number.alias("number"), at["file_path"].alias("file"), at["row_index"].alias("row")))
    except AnalysisException:
        return df.withColumn(name, F.monotonically_increasing_id())


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that none of ``taken`` equals, whatever its case."""
    have = {c.lower() for c in taken}
    while name.lower() in have:
        name += "_"
    return name
