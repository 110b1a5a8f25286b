"""Scalar expressions, all of Catalyst's own."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandspark.schema import LABELS, MONTHS, SYNONYMS


@lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, dict[str, str]]:
    """(characters, the one ASCII character that each is compatible with, characters that decompose into several), of all of Unicode."""
    one, several = {}, {}
    for c in map(chr, (*range(0x80, 0xD800), *range(0xE000, 0x30000))):
        plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if plain:
            (one if len(plain) == 1 else several)[c] = plain
    return "".join(one), "".join(one.values()), several


def fold_ascii(text: Column | str) -> Column:
    """Lower case, compatibility-decomposed, without anything that is not ASCII.

    Combining marks are no ASCII and stand apart once decomposed, so each character folds by itself: most by ``translate``; the few that
    decompose into several (a ligature, a fraction) by replacing those that are among what ``translate`` has left. Texts of ASCII
    alone are only lowered.
    """
    characters, plain, several = _decompositions()
    low = F.lower(F.col(text) if isinstance(text, str) else text)
    pairs = F.array(*(F.struct(F.lit(c).alias("c"), F.lit(p).alias("p")) for c, p in several.items()))

    def once(value: Column, use) -> Column:
        """``use`` of a value as a variable, which is worked out once and not for each pair."""
        return F.element_at(F.transform(F.array(value), use), 1)

    def spread(text: Column, left: Column) -> Column:
        found = F.filter(pairs, lambda x: F.contains(left, x["c"]))
        return F.regexp_replace(F.aggregate(found, text, lambda t, x: F.replace(t, x["c"], x["p"])), r"[^\x00-\x7F]+", "")

    folded = once(F.translate(low, characters, plain), lambda t: once(F.regexp_replace(t, r"[\x00-\x7F]+", ""), lambda left: F.when(left == "", t).otherwise(spread(t, left))))
    return F.when(low.rlike(r"[^\x00-\x7F]"), folded).otherwise(low)


def month_start(month_name: Column, year: Column) -> Column:
    """First day of a month given by its Spanish name in any case; null for an unknown name."""
    number = F.element_at(F.create_map(*(x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m), F.lit(i)))), F.lower(month_name))
    return F.make_date(year, number, F.lit(1))


def month_number(date: Column) -> Column:
    """Months since year 0; differences of it are whole calendar months."""
    return F.year(date) * 12 + F.month(date)


def months_between_starts(later: Column, earlier: Column) -> Column:
    return month_number(later) - month_number(earlier)


def season(month: Column, period: int = 12) -> tuple[Column, Column]:
    """Sine and cosine of the place in the year."""
    angle = 2 * F.pi() * month / period
    return F.sin(angle), F.cos(angle)


def first_label(text: Column, labels: Iterable[str] = LABELS) -> Column:
    """First label that the (folded) text contains, else 'unknown'."""
    return F.coalesce(*(F.when(text.contains(x), F.lit(x)) for x in labels), F.lit("unknown"))


def synonym(label: Column, synonyms: dict[str, str] | None = None) -> Column:
    """The label that another one stands for; exact match, not chained."""
    pairs = SYNONYMS if synonyms is None else synonyms
    if not pairs:
        return label
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), label), label)


def series_key(sku: Column, platform: Column) -> Column:
    return F.concat(sku.cast("string"), F.lit("_"), platform)


def last_token(key: Column) -> Column:
    """What follows the last underscore."""
    return F.element_at(F.split(key, "_"), -1)


def trim_all(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def finite(c: Column) -> Column:
    """Null for infinite or not-a-number values."""
    return F.when(F.abs(c) < float("inf"), c)


def total(c: Column) -> Column:
    """Sum that is 0 over nothing or nulls only."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean over the rows that have a value; null without weight."""
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def strip_unit(c: Column, unit: str) -> Column:
    """Number before a unit, as in '120 min' or '7.5/10'; null where there is none."""
    return F.trim(F.replace(c, F.lit(unit), F.lit(""))).try_cast("double")


def short_date(c: Column) -> Column:
    """Date written month/day/two-digit year; years from 69 are of the last century."""
    got = F.try_to_timestamp(c, F.lit("M/d/yy")).cast("date")
    return F.when(F.year(got) >= 2069, F.add_months(got, -1200)).otherwise(got)


def column_name(prefix: str, value: str) -> str:
    return (f"{prefix}_{value}" if prefix else value).replace(" ", "_").replace(".", "").lower()


def dummies(c: Column, prefix: str, values: Iterable[str]) -> list[Column]:
    """0/1 columns of chosen values."""
    return [F.when(c == v, 1).otherwise(0).alias(column_name(prefix, v)) for v in values]


def row_mean(values: Column) -> Column:
    """Mean of an array's non-null numbers."""
    real = F.filter(values, lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(real, F.lit(0.0), lambda a, x: a + x), F.size(real))


def row_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))


def price_cells(price: Column, low: int, cells: int, cell: int = 50, neighbours: int = 2, weights: Iterable[float] = (1.0, 0.5, 0.25)) -> Column:
    """Unit vector of price cells as its entries alone, an array of (cell, weight): the price's own cell and its neighbours, by falling weights; empty without price.

    What a price costs does not depend on how many cells there are.
    """
    weights = list(weights)[: neighbours + 1]
    reach = len(weights) - 1
    by_offset = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(float(weights[abs(k)])).alias("w")) for k in range(-reach, reach + 1)))
    at = F.floor((price - low) / cell).cast("int")
    own = F.filter(F.transform(by_offset, lambda x: F.struct((at + x["k"]).alias("cell"), x["w"].alias("weight"))), lambda x: x["cell"].between(0, cells - 1))
    norm = F.sqrt(F.aggregate(own, F.lit(0.0), lambda a, x: a + x["weight"] * x["weight"]))
    return F.transform(own, lambda x: F.struct(x["cell"].alias("cell"), (x["weight"] / (norm + 1e-9)).alias("weight")))


def price_vector(near: Column, cells: int) -> Column:
    """The entries that ``price_cells`` gives as a vector of all cells; all 0 without price."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    whole = F.concat(zeros(F.element_at(near, 1)["cell"]), F.transform(near, lambda x: x["weight"]), zeros(F.lit(cells - 1) - F.element_at(near, -1)["cell"]))
    return F.when(F.size(near) > 0, whole).otherwise(zeros(F.lit(cells)))


def pearson_residual(y: Column, mu: Column) -> Column:
    return F.coalesce(F.try_divide(y - mu, F.sqrt(mu)), F.lit(0.0))
