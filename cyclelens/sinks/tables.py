"""Parquet sinks. Every write that may be repeated replaces what it wrote before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclelens.operators.wash import REASON, mask, parse_lines
from cyclelens.schemas import schema_of
from cyclelens.session import FREE_SHUFFLES, file_system, settings


def write_log(
    df: DataFrame, path: str, codec: str = "snappy", mode: str = "errorifexists", by_date: bool = False
) -> None:
    """A log as Parquet. `codec` is any Parquet codec (snappy, gzip, lzo, zstd, …).

    `by_date` partitions the table, so that readers of some days skip the rest. Rows are
    rebalanced by date first: a small date gets one file, a large one is split."""
    if by_date:
        df = df.hint("rebalance", "date")
    # An overwrite replaces the whole table, whatever the session's setting is.
    writer = df.write.mode(mode).option("compression", codec).option("partitionOverwriteMode", "static")
    if by_date:
        writer = writer.partitionBy("date")
    writer.parquet(path)


def write_washed(
    raw: DataFrame,
    log: str,
    path: str,
    codec: str = "snappy",
    mode: str = "errorifexists",
    salt: str | None = None,
    by_date: bool = False,
) -> None:
    """Wash raw lines into `<path>/status=good` and `<path>/status=rejected` in one pass.

    Good rows have the log's columns and a null `value`; rejects keep the raw line there,
    their reason, and what else `raw` tells about them (an offset, a file name). With a
    `salt` the columns are masked. Raw lines are not: guard the rejects like the raw logs.

    `by_date` partitions both by date as well, and rebalances the rows for it: a small date
    gets one file, a large one is split."""
    bad = F.col(REASON).isNotNull()
    lines = parse_lines(raw, log)
    if salt is not None:
        lines = mask(lines, salt)
    rows = lines.select(
        *schema_of(log).names,
        F.when(bad, F.col("value")).alias("value"),
        *[c for c in raw.columns if c != "value"],
        REASON,
        F.when(bad, "rejected").otherwise("good").alias("status"),
    )
    parts = ["status", "date"] if by_date else ["status"]
    if by_date:
        rows = rows.hint("rebalance", *parts)
    writer = rows.write.mode(mode).option("compression", codec).option("partitionOverwriteMode", "static")
    writer.partitionBy(*parts).parquet(path)


def _replace_days(df: DataFrame, path: str, day: str, **options: str) -> None:
    (
        df.write.mode("overwrite")
        .options(**options)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


# Of stored lines: lines of a file and bytes of a row group at most, so that a task has few of
# them in memory and many tasks read a batch.
_STORED_LINES, _STORED_GROUP_BYTES = 20_000, 16 << 20


def write_lines(lines: DataFrame, path: str, batches: int, kind: str = "text") -> int:
    """Raw lines (`value`) as files under `path`, for a stream in `batches` batches; returns
    how many files make one. The path must be new.

    Each task deals its own lines to a file for each batch, without a shuffle, so no task
    reads more than its part of the input, however few the batches are. The files are
    written side by side, which spares a sort of the lines.

    `kind` is text or parquet (one column, zstd), which takes about a sixth of the disk: lines
    repeat their field names, and those of one order or user stand together. It is for lines
    without line breaks, as JSON has them; null is an empty line in both."""
    spark = lines.sparkSession
    part = F.pmod(F.monotonically_increasing_id(), F.lit(batches)).alias("part")
    # The files of a shuffle below are of no more use when the lines are written.
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(batches), **FREE_SHUFFLES}):
        if kind == "text":
            lines.select("value", part).write.partitionBy("part").text(path)
        else:
            value = F.coalesce("value", F.lit("")).alias("value")
            options = {
                "compression": "zstd", "maxRecordsPerFile": _STORED_LINES,
                "parquet.block.size": _STORED_GROUP_BYTES, "parquet.enable.dictionary": "false",
            }
            lines.select(value, part).write.partitionBy("part").options(**options).parquet(path)
    files, found = file_system(spark, f"{path}/part=*/part-*")
    return max(1, -(-len(files.globStatus(found)) // batches))


def write_report(df: DataFrame, path: str) -> None:
    """A report, partitioned by date. Dates not in `df` stay as they are."""
    _replace_days(df.hint("rebalance", "date"), path, "date")


def write_bitmaps(sets: DataFrame, path: str) -> None:
    """Bitmaps (date, …, bucket, bits), partitioned by date. Other dates stay."""
    _replace_days(sets.hint("rebalance", "date"), path, "date", compression="zstd")


# Rows of a row group of the tag detail, about: small ones, so that few rows are read for
# a user.
_DETAIL_GROUP_BYTES = 4 << 20


def write_detail(detail: DataFrame, path: str, group_bytes: int = _DETAIL_GROUP_BYTES) -> None:
    """Tag detail rows (userid, day, tags), partitioned by day. Other days stay.

    Within a day files hold ranges of users, sorted, in small row groups with a Bloom filter
    of their users. So the rows of a user are found from the files' statistics, and a user
    who has none on a day is mostly found missing without reading."""
    ordered = detail.repartitionByRange("day", "userid").sortWithinPartitions("day", "userid")
    bloom = {"parquet.bloom.filter.enabled#userid": "true", "parquet.bloom.filter.adaptive.enabled#userid": "true"}
    _replace_days(ordered, path, "day", **bloom, **{"parquet.block.size": str(group_bytes)})


def detail_of(spark: SparkSession, path: str, users: list[str], days: list[str] | None = None) -> DataFrame:
    """The stored detail (userid, day, tags) of some users, on some days or on all."""
    stored = spark.read.schema("userid string, tags string, day string").parquet(path)
    found = stored.where(F.col("userid").isin(users))
    found = found if days is None else found.where(F.col("day").isin(days))
    return found.select("userid", "day", "tags")


def write_tag_index(tags: DataFrame, path: str) -> None:
    """The long tag table laid out for search by tag.

    Sorting by tag lets a search skip the files and row groups of other tags. The range
    includes the user, so a tag that most users carry spreads over many files."""
    ordered = tags.repartitionByRange("tag", "userid").sortWithinPartitions("tag", "userid")
    ordered.write.mode("overwrite").parquet(path)


def write_postings(postings: DataFrame, path: str) -> None:
    """Posting lists (tag, bucket, bits), laid out for search by tag as the tag index is."""
    ordered = postings.repartitionByRange("tag", "bucket").sortWithinPartitions("tag", "bucket")
    ordered.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_numbers(numbers: DataFrame, path: str) -> None:
    """Numbers of users (value, number), laid out for looking names up by number. Do not
    overwrite the path they are read from."""
    ordered = numbers.repartitionByRange("number").sortWithinPartitions("number")
    ordered.write.mode("overwrite").parquet(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """Search documents (id, timestamp, tags)."""
    documents.write.mode("overwrite").parquet(path)


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """The geohash -> district dictionary. Do not overwrite the path it is read from."""
    dictionary.write.mode("overwrite").parquet(path)
