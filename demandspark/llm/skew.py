"""Joins by keys of which some have very many rows, and of wide rows of which few have a match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm import store

#: A key with over 1/SHARE of the rows is hot; so there are fewer than SHARE hot keys, however many rows there are.
SHARE = 50_000
#: Bits of the bitmap that tells rows without a match: 4 MB, whatever the table.
BITS = 1 << 25


def hot_of(counted: DataFrame, keys: list[str], rows: str = "rows") -> DataFrame:
    """(keys, rows, all_rows): the keys that hold over 1/SHARE of all rows counted; under SHARE of them, so they can be broadcast.

    ``counted`` has a row per key with its number of rows, and is a written table, as it is read again.
    """
    total = counted.agg(F.sum(rows)).first()[0] or 0
    return counted.where(F.col(rows) * SHARE > total).select(*keys, F.col(rows).alias("rows"), F.lit(total).cast("long").alias("all_rows"))


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one narrow row per key.

    Rows of hot keys meet a broadcast part of the table (fewer than SHARE rows), all others are shuffled; so no task gets
    the rows of a hot key.
    """
    few = F.broadcast(hot.select(*keys))
    warm = rows.join(few, keys, "left_semi").join(F.broadcast(table.join(few, keys, "left_semi")), keys, how)
    cold = rows.join(few, keys, "left_anti").join(table, keys, how)
    return warm.unionByName(cold)


def salted(rows: DataFrame, hot: DataFrame, key: str, by: str, name: str) -> DataFrame:
    """Adds a salt: 0 for most keys, and for a hot one a number by hash of ``by``, so that a (key, salt) has about 1/SHARE of the rows."""
    salts = hot.select(key, salts_of().alias("_salts"))
    return rows.join(F.broadcast(salts), key, "left").withColumn(name, F.coalesce(F.pmod(F.xxhash64(by), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")


def for_salts(table: DataFrame, hot: DataFrame, key: str, name: str) -> DataFrame:
    """A copy of a row of ``table`` for each salt of its key: one for most, and in all at most SHARE more than rows."""
    salts = hot.select(key, salts_of().alias("_salts"))
    return table.join(F.broadcast(salts), key, "left").withColumn(name, F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")


def salts_of():
    return F.ceil(F.col("rows") * SHARE / F.col("all_rows")).cast("int")


def may_match(rows: DataFrame, table: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``rows`` with a column ``name`` that is false only where ``table`` surely has no such keys.

    Told by a broadcast bitmap of the hashes of the table's keys, so that wide rows without a match need no shuffle; a join
    decides on the others. With many more keys than BITS nearly all rows are left to the join.
    """
    part, bits = (store.fresh(x, rows.columns) for x in ("_part", "_bits"))
    at = F.pmod(F.xxhash64(*keys), F.lit(BITS)) + 1
    bit = F.bitmap_bit_position(at).cast("int")
    maps = table.groupBy(F.bitmap_bucket_number(at).alias(part)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias(bits))
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    told = F.coalesce(F.getbit(byte, F.pmod(bit, F.lit(8))) == 1, F.lit(False))
    return rows.withColumn(part, F.bitmap_bucket_number(at)).join(F.broadcast(maps), part, "left").withColumn(name, told).drop(part, bits)
