"""Exact distinct counts as bitmaps over numbered values.

Users and bikes get numbers once; a set of them is then a bitmap, and sets of days and
cities are merged by OR without going back to the rows. Numbers are positive and, for each
task that gives them out, without gaps, so a bucket of 32,768 numbers is mostly full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelens.operators.lookup import BROADCAST_BYTES, lookup
from cyclelens.session import written

BUCKET = 32_768  # bits of one bitmap, fixed by the SQL functions


def numbered(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(value, number): every non-null value of a one-column table with its number. Values
    that `known`, an earlier result, holds keep theirs; the others get new ones.

    The result is stored, since numbers must not change when a task is run again."""
    fresh = values.toDF("value").where("value is not null").distinct()
    first = 1
    if known is not None:
        fresh = fresh.join(known, "value", "left_anti")
        first += known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    fresh = fresh.withColumn("number", F.lit(first) + F.monotonically_increasing_id())
    return written(fresh if known is None else known.unionByName(fresh), "numbers")


def with_number(
    df: DataFrame, column: str, numbers: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """`df` with `<column>_no`, the number of its value; null for a null value."""
    names = numbers.select(F.col("value").alias(column), F.col("number").alias(f"{column}_no"))
    return lookup(df, names, column, broadcast_bytes)


def bitmaps(df: DataFrame, keys: tuple[str, ...], column: str, gathered: bool = False) -> DataFrame:
    """(keys…, bucket, bits): the set of `<column>_no` of each key, a bitmap for each bucket
    of numbers. Tasks make their part of a bitmap first, so no key is hot.

    With few rows for a bitmap in each task that is 4 KB for a row or two, and tasks times
    bitmaps grow with the square of the input. `gathered`, for rows that do not repeat a
    number of a key, brings the rows of a bitmap together first: 32,768 at most."""
    number = F.col(f"{column}_no")
    bits = df.where(number.isNotNull()).select(
        *keys, F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit")
    )
    if gathered:
        bits = bits.repartition(*keys, "bucket")
    return bits.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def any_of(sets: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The union of sets, by coarser keys."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def all_of(sets: DataFrame, keys: tuple[str, ...], members: int) -> DataFrame:
    """The common part of `members` sets by coarser keys; each set has at most one row for
    each key and bucket. A bucket that a set lacks is empty in it."""
    met = sets.groupBy(*keys, "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("sets"))
    return met.where(F.col("sets") == members).drop("sets")


def counted(sets: DataFrame, keys: tuple[str, ...], name: str) -> DataFrame:
    """(keys…, name): how many numbers each set has; a set that became empty has 0."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def members(sets: DataFrame) -> DataFrame:
    """The numbers in sets: the other columns, and `number`.

    Only words with a bit set are taken apart."""
    others = [c for c in sets.columns if c not in ("bucket", "bits")]
    word = lambda i: F.hex(F.substring("bits", i * 8 + 1, F.lit(8)))
    words = sets.select(
        *others, "bucket", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BUCKET // 64 - 1)), word)).alias("at", "word")
    ).where(F.col("word") != "0" * 16)

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.substring("word", F.call_function("div", bit, F.lit(8)).cast("int") * 2 + 1, F.lit(2)), 16, 10)
        return F.call_function("shiftright", byte.cast("int"), (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), is_set)
    number = (F.col("bucket") - 1) * BUCKET + F.col("at") * 64 + F.col("bit") + 1
    return words.select(*others, "bucket", "at", F.explode(bits).alias("bit")).select(*others, number.alias("number"))
