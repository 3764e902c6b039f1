"""Points, geocoder replies and the geohash -> district dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclelens.functions.geo import decode_reply, geohash8, in_bounds


def distinct_points(df: DataFrame) -> DataFrame:
    """Distinct (latitude, longitude) inside the bounding box."""
    return (
        df.select("latitude", "longitude")
        .where(in_bounds(F.col("latitude"), F.col("longitude")))
        .distinct()
    )


def decode_replies(replies: DataFrame) -> DataFrame:
    """Stored replies (latitude, longitude, reply) as (latitude, longitude, business).

    `business` is null where a reply names no district."""
    return replies.select("latitude", "longitude", decode_reply(F.col("reply")).alias("business"))


def geo_dictionary(points: DataFrame, replies: DataFrame) -> DataFrame:
    """(geohash8, business) for the points that have a reply naming a district.

    Points of one cell may have different replies. The largest (latitude, longitude)
    decides, so that the dictionary does not depend on the order of the rows.
    """
    answered = points.join(decode_replies(replies), ["latitude", "longitude"])
    # A filter on the decoded column would be pushed down and decode every reply twice.
    entry = F.when(F.col("business").isNotNull(), F.struct("latitude", "longitude", "business"))
    return (
        answered.groupBy(geohash8(F.col("latitude"), F.col("longitude")).alias("geohash8"))
        .agg(F.max(entry).alias("last"))
        .where(F.col("last").isNotNull())
        .select("geohash8", "last.business")
    )


def geo_misses(points: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Cells that still need a lookup: (geohash8, latitude, longitude).

    One point per cell is enough, since its reply fills the entry for the whole cell.
    Both sides of the anti join are unique on the cell, so no key is hot. An entry
    with an empty district list counts as missing.
    """
    cells = (
        points.where(in_bounds(F.col("latitude"), F.col("longitude")))
        .groupBy(geohash8(F.col("latitude"), F.col("longitude")).alias("geohash8"))
        .agg(F.max(F.struct("latitude", "longitude")).alias("point"))
        .select("geohash8", "point.latitude", "point.longitude")
    )
    known = dictionary.where(F.col("business") != "").select("geohash8")
    return cells.join(known, "geohash8", "left_anti")


def merge_dictionary(known: DataFrame, fresh: DataFrame) -> DataFrame:
    """`known` with the entries of `fresh` added; a fresh entry replaces a known one.

    Both sides are unique on the cell, so no key is hot."""
    both = known.withColumnRenamed("business", "old").join(fresh, "geohash8", "full")
    return both.select("geohash8", F.coalesce("business", "old").alias("business"))


def completed_dictionary(points: DataFrame, known: DataFrame, replies: DataFrame) -> DataFrame:
    """`known` with entries for the cells it misses, from stored replies to one point of
    each missing cell. Cells whose reply names no district stay missing."""
    misses = geo_misses(points, known).select("latitude", "longitude")
    return merge_dictionary(known, geo_dictionary(misses, replies))
