"""User tags as a standing table that a day's rides are merged into.

`<path>/days/` holds the tags of each day that was merged, `<path>/totals/version=N` the
sums over all days, and `<path>/days_of/version=N` says which run of each day version N
holds. A day that is merged again replaces itself: what its earlier run added is taken off
again, by key. A version counts when its list of days is complete, so a merge that fails
changes nothing, and may simply be repeated. Days may come in any order; one merge runs at
a time.

Totals are one row and one map of tags for each user, in buckets by user. A merge joins the
day to them bucket by bucket: the totals are read and written, but not shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclelens.session import delete_folder, folder_names
from cyclelens.sinks.buckets import read_bucketed, write_bucketed

BUCKETS = 64
_MAPS = T.StructType([
    T.StructField("userid", T.StringType()), T.StructField("tags", T.MapType(T.StringType(), T.LongType())),
])
_DAYS = "day string, run string"


def _as_maps(tags: DataFrame) -> DataFrame:
    """(userid, tags) from (userid, tag, cnt)."""
    return tags.groupBy("userid").agg(
        F.map_from_entries(F.collect_list(F.struct("tag", F.col("cnt").cast("bigint").alias("cnt")))).alias("tags")
    )


def _added(left: Column, right: Column, sign: int) -> Column:
    """Two maps added (or one taken off the other) tag by tag; a null map is empty."""
    empty = F.create_map().cast("map<string,bigint>")
    return F.map_zip_with(
        F.coalesce(left, empty), F.coalesce(right, empty),
        lambda _, a, b: F.coalesce(a, F.lit(0)) + sign * F.coalesce(b, F.lit(0)),
    )


class StandingTags:
    """The standing table under `path`, which all executors share."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _read(self, folder: str) -> DataFrame:
        return read_bucketed(self.spark, folder, _MAPS, ("userid",), self.buckets)

    def version(self) -> int | None:
        """Number of the newest complete version."""
        done = folder_names(self.spark, f"{self.path}/days_of/version=*/_SUCCESS")
        return max((int(name.split("=")[1]) for name in done), default=None)

    def _runs(self, version: int) -> DataFrame:
        return self.spark.read.schema(_DAYS).parquet(f"{self.path}/days_of/version={version}")

    def days(self) -> list[str]:
        """The days that the newest version holds."""
        version = self.version()
        return [] if version is None else sorted(r["day"] for r in self._runs(version).collect())

    def merge(self, day: str, tags: DataFrame) -> None:
        """Merge the tags (userid, tag, cnt) of one day; a day merged before is replaced."""
        version, run = self.version(), f"{day}.{uuid.uuid4().hex}"
        write_bucketed(_as_maps(tags), f"{self.path}/days/{run}", ("userid",), self.buckets)
        change, runs = self._read(f"{self.path}/days/{run}"), None
        if version is not None:
            runs = self._runs(version)
            for earlier in runs.where(F.col("day") == day).collect():
                old = self._read(f"{self.path}/days/{earlier['run']}").withColumnRenamed("tags", "old")
                change = change.join(old, "userid", "full").select("userid", _added(F.col("tags"), F.col("old"), -1).alias("tags"))
            change = change.withColumnRenamed("tags", "change")
            totals = self._read(f"{self.path}/totals/version={version}")
            totals = totals.join(change, "userid", "full").select("userid", _added(F.col("tags"), F.col("change"), 1).alias("tags"))
        else:
            totals = change
        kept = totals.select("userid", F.map_filter("tags", lambda _, n: n != 0).alias("tags")).where(F.size("tags") > 0)
        following = 0 if version is None else version + 1
        for left_over in ("totals", "days_of"):  # of a merge that failed
            delete_folder(self.spark, f"{self.path}/{left_over}/version={following}")
        write_bucketed(kept, f"{self.path}/totals/version={following}", ("userid",), self.buckets)
        merged = self.spark.createDataFrame([(day, run)], _DAYS)
        if runs is not None:
            merged = merged.unionByName(runs.where(F.col("day") != day))
        merged.coalesce(1).write.parquet(f"{self.path}/days_of/version={following}")

    def documents(self) -> DataFrame:
        """(userid, tags): one map of tags for each user, over all days."""
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], _MAPS)
        return self._read(f"{self.path}/totals/version={version}")

    def tags(self) -> DataFrame:
        """(userid, tag, cnt) over all days, as `user_tags` gives it."""
        return self.documents().select("userid", F.explode("tags").alias("tag", "cnt"))

    def drop_replaced(self) -> None:
        """Remove the versions and runs that the newest version replaced. Queries that still
        read them must have ended."""
        newest = self.version()
        if newest is None:
            return
        kept = {r["run"] for r in self._runs(newest).collect()} | {f"version={newest}"}
        for part in ("days", "totals", "days_of"):
            for name in folder_names(self.spark, f"{self.path}/{part}/*"):
                if name not in kept:
                    delete_folder(self.spark, f"{self.path}/{part}/{name}")
