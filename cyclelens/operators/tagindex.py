"""Search by tag over posting lists.

For each tag the numbered users who carry it are a set of bitmaps. A search for several
tags is an AND or OR of their bitmaps, bucket by bucket; user names are looked up for the
result only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelens.operators import bitmaps
from cyclelens.operators.lookup import BROADCAST_BYTES


def postings(tags: DataFrame, numbers: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(tag, bucket, bits) from (userid, tag, …), a row for each user and tag, and the users'
    numbers."""
    numbered = bitmaps.with_number(tags, "userid", numbers, broadcast_bytes)
    return bitmaps.bitmaps(numbered, ("tag",), "userid", gathered=True)


def search(index: DataFrame, wanted: list[str], match: str = "all") -> DataFrame:
    """(bucket, bits): the users who carry all (or any) of the wanted tags."""
    if match not in ("all", "any"):
        raise ValueError(f"match must be 'all' or 'any', not {match!r}")
    wanted = sorted(set(wanted))
    lists = index.where(F.col("tag").isin(wanted)).select("bucket", "bits")
    return bitmaps.all_of(lists, (), len(wanted)) if match == "all" else bitmaps.any_of(lists, ())


def users(found: DataFrame, numbers: DataFrame) -> DataFrame:
    """`userid` of the users in a search result."""
    return numbers.join(bitmaps.members(found), "number").select(F.col("value").alias("userid"))


def users_by_tag(index: DataFrame, numbers: DataFrame, wanted: list[str], match: str = "all") -> DataFrame:
    """`userid` of the users who carry all (or any) of the wanted tags."""
    return users(search(index, wanted, match), numbers)
