"""Tables between the steps of a job, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Tables kept within the scopes that are open, newest scope last.
_SCOPES: list[list[DataFrame]] = []


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a temporary folder, which only a local master can share."""
    got = spark.conf.get("spark.checkpoint.dir", None)
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        got = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table and read it again.

    What is used several times is then computed once, and a lost executor costs nothing that is already written.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    got = spark.read.schema(df.schema).parquet(path)
    got._kept_at = path
    if _SCOPES:
        _SCOPES[-1].append(got)
    return got


def keep_observed(df: DataFrame, name: str, metrics: dict[str, list[Column]], without: Iterable[str] = ()) -> tuple[DataFrame, dict[str, dict]]:
    """As ``keep``, and for every entry of ``metrics`` its aggregates over the rows, observed on the write; ``without`` are columns not to write."""
    seen = {k: Observation(k) for k in metrics}
    rows = df
    for k, columns in metrics.items():
        rows = rows.observe(seen[k], *columns)
    kept = keep(rows.drop(*without), name)
    # a plan that is known to be empty is not run, so nothing is seen
    return kept, {k: o.get or df.agg(*metrics[k]).first().asDict() for k, o in seen.items()}


def drop(*tables: DataFrame) -> None:
    """Delete tables that ``keep`` gave and that no later step reads any more."""
    for df in tables:
        if path := df.__dict__.pop("_kept_at", None):
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scope() -> Iterator[None]:
    """Deletes at its end the tables kept within it, for a job whose result is written by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        drop(*_SCOPES.pop())
