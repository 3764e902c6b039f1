"""Per-user tag counts and the tables made from them.

The tag vocabulary without districts is closed (fourteen tags), so those tags are
counted as fourteen counters per user and turned into rows afterwards: rides are never
multiplied by their tags before the shuffle. District tags come from the dictionary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelens.functions.geo import geohash8, in_bounds
from cyclelens.functions.tags import district_names, district_tag, fixed_tag_rules
from cyclelens.operators.lookup import BROADCAST_BYTES, lookup
from cyclelens.sinks.buckets import read_bucketed, write_bucketed

# Columns of a ride that its tags are read from.
TAGGED = ("latitude", "longitude", "client", "deviceType", "networkingmannerid", "unlock", "distance")
CELL_SALTS = 8
_CELL = ("geohash8", "salt")


def named_users(rides: DataFrame) -> DataFrame:
    """Rides of a known user: neither '' nor null."""
    return rides.where(F.col("userid") != "")


def ride_cell() -> Column:
    """Geohash of a ride inside the bounding box, else null."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return F.when(in_bounds(lat, lon), geohash8(lat, lon))


def with_districts(
    rides: DataFrame, dictionary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every ride with the column `business`: the district list of its cell, or null."""
    return lookup(
        rides.withColumn("geohash8", ride_cell()),
        dictionary,
        "geohash8",
        broadcast_bytes,
    ).drop("geohash8")


def write_cells(rides: DataFrame, path: str, buckets: int, salts: int = CELL_SALTS) -> None:
    """Rides with their cell under `path`, in buckets by cell, for `with_stored_districts`.

    A busy cell is dealt to `salts` buckets. Rides without a cell, which find no district,
    lie apart and are not dealt at all."""
    placed = rides.withColumn("geohash8", ride_cell())
    salt = F.pmod(F.xxhash64("sessionid"), F.lit(salts)).cast("int")
    dealt = placed.where(F.col("geohash8").isNotNull()).withColumn("salt", salt)
    write_bucketed(dealt, f"{path}/placed", _CELL, buckets)
    placed.where(F.col("geohash8").isNull()).write.parquet(f"{path}/unplaced")


def write_districts(dictionary: DataFrame, path: str, buckets: int, salts: int = CELL_SALTS) -> None:
    """The dictionary under `path`, in the same buckets: an entry for each salt."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    write_bucketed(dictionary.select("geohash8", "business", salt), path, _CELL, buckets)


def with_stored_districts(
    spark: SparkSession, cells: str, districts: str, ride_schema: T.StructType, buckets: int
) -> DataFrame:
    """As `with_districts`, from the tables that `write_cells` and `write_districts` stored:
    a join of any size without an exchange."""
    key = [T.StructField("geohash8", T.StringType()), T.StructField("salt", T.IntegerType())]
    placed = read_bucketed(spark, f"{cells}/placed", T.StructType([*ride_schema.fields, *key]), _CELL, buckets)
    words = T.StructType([T.StructField("geohash8", T.StringType()), T.StructField("business", T.StringType()), key[1]])
    dictionary = read_bucketed(spark, districts, words, _CELL, buckets)
    found = placed.join(dictionary.hint("merge"), list(_CELL), "left").select(*ride_schema.names, "business")
    unplaced = spark.read.schema(ride_schema).parquet(f"{cells}/unplaced")
    return found.unionByName(unplaced.withColumn("business", F.lit(None).cast("string")))


def _fixed_counters(rides: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One counter column per tag of the closed vocabulary, and one row per key."""
    return named_users(rides).groupBy(*keys).agg(
        *[F.count_if(hit).alias(tag) for tag, hit in fixed_tag_rules().items()]
    )


def fixed_tag_counts(rides: DataFrame, keys: tuple[str, ...] = ("userid",)) -> DataFrame:
    """(keys…, tag, cnt) for the closed vocabulary. One shuffle, one row per key and task."""
    counted = _fixed_counters(rides, keys)
    return counted.unpivot(list(keys), list(fixed_tag_rules()), "tag", "cnt").where(F.col("cnt") > 0)


def district_tag_counts(
    rides: DataFrame,
    dictionary: DataFrame,
    keys: tuple[str, ...] = ("userid",),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(keys…, tag, cnt) for districts. Rides without a cell carry none and are left out.

    Rides are first counted per key and cell, so a busy user or cell reaches the join as
    one row per user and cell.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    visits = (
        named_users(rides)
        .where(in_bounds(lat, lon))
        .groupBy(*keys, geohash8(lat, lon).alias("geohash8"))
        .agg(F.count(F.lit(1)).alias("rides"))
    )
    found = lookup(visits, dictionary, "geohash8", broadcast_bytes)
    # The tags of `business_tags`, made after the list is rows, where no lambda is interpreted.
    named = found.select(*keys, "rides", F.explode(district_names(F.col("business"))).alias("name"))
    tagged = named.where(F.col("name") != "").select(*keys, "rides", district_tag(F.col("name")).alias("tag"))
    return tagged.groupBy(*keys, "tag").agg(F.sum("rides").alias("cnt"))


def user_tags(
    rides: DataFrame,
    dictionary: DataFrame | None = None,
    keys: tuple[str, ...] = ("userid",),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(keys…, tag, cnt): tag weights summed over all rides of a user.

    `keys=("userid", "date")` keeps the days apart, as decay and the daily detail need.
    The two halves share no tag, so their union needs no further aggregation.
    """
    fixed = fixed_tag_counts(rides, keys)
    if dictionary is None:
        return fixed
    return fixed.unionByName(district_tag_counts(rides, dictionary, keys, broadcast_bytes))


def tag_lists(
    rides: DataFrame,
    dictionary: DataFrame,
    keys: tuple[str, ...] = ("userid",),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(keys…, entries): the rows of `user_tags` gathered per key as (tag, cnt) structs.

    The counters become an array where they are, already partitioned by key, and meet
    the district entries in a join on the same key. Gathering the long table instead
    would shuffle every tag of every user once more. A list holds distinct tags, so the
    tag vocabulary bounds it.
    """
    counters = [
        F.when(F.col(tag) > 0, F.struct(F.lit(tag).alias("tag"), F.col(tag).alias("cnt")))
        for tag in fixed_tag_rules()
    ]
    fixed = _fixed_counters(rides, keys).select(
        *keys, F.array_compact(F.array(*counters)).alias("fixed")
    )
    counts = district_tag_counts(rides, dictionary, keys, broadcast_bytes)
    districts = _gathered(counts, keys).withColumnRenamed("entries", "districts")
    nothing = F.array().cast("array<struct<tag:string,cnt:bigint>>")
    # Every key with a district has a counter row, so a left join keeps all.
    entries = F.concat("fixed", F.coalesce("districts", nothing))
    return (
        fixed.join(districts, list(keys), "left")
        .where((F.size("fixed") > 0) | F.col("districts").isNotNull())
        .select(*keys, entries.alias("entries"))
    )


def _gathered(tags: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return tags.groupBy(*keys).agg(F.collect_list(F.struct("tag", "cnt")).alias("entries"))


def tag_detail(daily_tags: DataFrame, day: str | None = None) -> DataFrame:
    """(userid, day, tags) with tags as 'tag:n,tag:n' in tag order.

    `daily_tags` is the long table or the lists by user and date. `day` keeps a single
    date; without it every date gets its own row.
    """
    if day is not None:
        daily_tags = daily_tags.where(F.col("date") == day)
    if "entries" not in daily_tags.columns:
        daily_tags = _gathered(daily_tags, ("userid", "date"))
    return daily_tags.select(
        "userid", F.col("date").alias("day"), tag_text(F.col("entries")).alias("tags")
    )


def tag_text(entries: Column) -> Column:
    """An array of (tag, cnt) structs as 'tag:n,tag:n' in tag order."""
    pairs = F.transform(
        F.array_sort(entries), lambda e: F.concat_ws(":", e["tag"], e["cnt"].cast("string"))
    )
    return F.array_join(pairs, ",")


def detail_wide(detail: DataFrame, days: list[str]) -> DataFrame:
    """One row per user and one column 'day <date>' per listed date."""
    wide = detail.groupBy("userid").pivot("day", days).agg(F.first("tags"))
    return wide.select("userid", *[F.col(d).alias(f"day {d}") for d in days])


def tag_document(tags: DataFrame, now_ms: int) -> DataFrame:
    """Search documents (id, timestamp, tags): all tags of a user as a map.

    `tags` is the long table or the lists by user."""
    if "entries" not in tags.columns:
        tags = _gathered(tags, ("userid",))
    entries = F.array_sort("entries")
    return tags.select(
        F.col("userid").alias("id"),
        F.lit(now_ms).cast("bigint").alias("timestamp"),
        F.map_from_entries(entries).alias("tags"),
    )


def users_by_tag(
    tags: DataFrame, wanted: list[str], match: str = "all", min_count: int = 1
) -> DataFrame:
    """Users who carry all (or any) of the wanted tags, each at least `min_count` times.

    `tags` has one row per user and tag, as `user_tags` returns it."""
    if match not in ("all", "any"):
        raise ValueError(f"match must be 'all' or 'any', not {match!r}")
    wanted = sorted(set(wanted))
    hits = tags.where(F.col("tag").isin(wanted) & (F.col("cnt") >= min_count))
    need = len(wanted) if match == "all" else 1
    return (
        hits.groupBy("userid")
        .agg(F.count(F.lit(1)).alias("matched"))
        .where(F.col("matched") >= need)
        .select("userid")
    )


def tag_decay(daily_tags: DataFrame, as_of: str, half_life_days: float) -> DataFrame:
    """(userid, tag, weight): counts that halve every `half_life_days` before `as_of`.

    The exponential form and the half-life are this project's choice. Days after
    `as_of` are left out.
    """
    age = F.date_diff(F.lit(as_of).cast("date"), F.col("date").cast("date"))
    weight = F.col("cnt") * F.pow(F.lit(0.5), age / F.lit(float(half_life_days)))
    return (
        daily_tags.where(F.col("date") <= as_of)
        .groupBy("userid", "tag")
        .agg(F.sum(weight).alias("weight"))
    )
