"""Relabelling of products and licenses by ordered rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.functions import scalars as S
from demandspark.schema import LABELS, LICENSE_RULES


def relabel_license(df: DataFrame, rules: Iterable[tuple[str, str, str]] = LICENSE_RULES) -> DataFrame:
    """New license where the old one and a text in the description (any case) match; the first matching rule wins."""
    case, text = None, F.lower("description")
    for old, part, new in rules:
        hit = (F.col("license") == old) & text.contains(part.lower())
        case = F.when(hit, F.lit(new)) if case is None else case.when(hit, F.lit(new))
    return df if case is None else df.withColumn("license", case.otherwise(F.col("license")))


def with_product(df: DataFrame, labels: Iterable[str] = LABELS, synonyms: dict[str, str] | None = None) -> DataFrame:
    """Product label of the description."""
    return df.withColumn("product", S.synonym(S.first_label(S.fold_ascii("description"), labels), synonyms))
