"""Long tables to wide ones and back."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def widen(df: DataFrame, keys: Iterable[str], by: Column, values: Iterable, measure: str, prefix: str = "") -> DataFrame:
    """A column of summed measures for each of the given values of ``by``; one aggregation, no job to find the values."""
    sums = [F.sum(F.when(by == F.lit(v), F.col(measure))).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(*keys).agg(*sums)


def lengthen(df: DataFrame, keys: Iterable[str], columns: Iterable[str], name: str, measure: str) -> DataFrame:
    """A row for each of the columns, with its name and value."""
    return df.unpivot(list(keys), list(columns), name, measure)
