"""End-to-end jobs: from a path to stored results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cyclelens.operators import bitmaps, geodict, tagindex, usertags
from cyclelens.operators.reports import G3, ReportSpec, report, report_from_suite, report_suite
from cyclelens.plans.catalog import reports_of
from cyclelens.plans.standing import StandingTags
from cyclelens.session import scratch, written
from cyclelens.sinks import tables
from cyclelens.sources.kafka import kafka_lines
from cyclelens.sources.logs import read_lines, read_log
from cyclelens.streaming.rollups import start_rollups


def wash_job(
    spark: SparkSession, log: str, source: str, target: str, codec: str = "snappy",
    salt: str | None = None, by_date: bool = True,
) -> None:
    """Raw text logs to washed Parquet under `<target>/status=good`, by date, so that jobs
    on some days read these days only."""
    tables.write_washed(read_lines(spark, source), log, target, codec=codec, salt=salt, by_date=by_date)


def numbered_log(df: DataFrame, columns: tuple[str, ...], known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A log with `<column>_no` for each of `columns`: numbers that `known` holds, and new
    ones for other values."""
    for column in columns:
        numbers = bitmaps.numbered(df.select(column), (known or {}).get(column))
        df = bitmaps.with_number(df, column, numbers)
    return df


def all_reports(df: DataFrame, log: str, epoch_unit: str = "ms") -> dict[ReportSpec, DataFrame]:
    """Every report of one log. The count and sum reports share one scan, whose result is
    stored. Distinct counts share it too if their values are numbered (`numbered_log`);
    otherwise they need the rows themselves and scan two or so columns each."""
    specs = reports_of(log)
    shared = [s for s in specs if all(f"{c}_no" in df.columns for c in s.counted_values)]
    suite = written(report_suite(df, shared, epoch_unit), f"suite-{log}", partition_by="set_id")
    return {
        s: report_from_suite(suite, shared, s) if s in shared else report(df, s, epoch_unit)
        for s in specs
    }


def report_job(
    spark: SparkSession,
    log: str,
    source: str,
    sink: Callable[[DataFrame, ReportSpec], None],
    epoch_unit: str = "ms",
) -> None:
    """All reports of a washed log, each handed to `sink` with its spec. `sink` must have
    stored the rows when it returns: the shared table they come from is then removed."""
    with scratch(spark):
        for spec, rows in all_reports(read_log(spark, source, log), log, epoch_unit).items():
            sink(rows, spec)


def dictionary_job(spark: SparkSession, log: str, source: str, replies: DataFrame, target: str) -> None:
    """Dictionary of the points of a washed log, from stored geocoder replies."""
    points = geodict.distinct_points(read_log(spark, source, log))
    tables.write_dictionary(geodict.geo_dictionary(points, replies), target)


def completion_job(
    spark: SparkSession, log: str, source: str, known: DataFrame, replies: DataFrame, target: str
) -> None:
    """A new dictionary at `target`: the stored one `known`, completed for the points of a
    washed log. `target` must not be where `known` is read from."""
    points = geodict.distinct_points(read_log(spark, source, log))
    tables.write_dictionary(geodict.completed_dictionary(points, known, replies), target)


def rides_of(spark: SparkSession, source: str, day: str) -> DataFrame:
    """One day's rides of a washed log; of a log by date, only this day's folder is read."""
    return read_log(spark, source, "unlock").where(F.col("date") == day)


def detail_job(spark: SparkSession, source: str, dictionary: DataFrame, target: str, day: str) -> None:
    """Tag detail of one day's rides."""
    lists = usertags.tag_lists(rides_of(spark, source, day), dictionary, ("userid", "date"))
    tables.write_detail(usertags.tag_detail(lists, day), target)


def standing_job(spark: SparkSession, source: str, dictionary: DataFrame, target: str, day: str) -> None:
    """Merge one day's rides into the standing tags under `target`; again, if need be."""
    tags = usertags.user_tags(rides_of(spark, source, day), dictionary)
    standing = StandingTags(spark, target)
    standing.merge(day, tags)


def bitmap_job(
    spark: SparkSession, log: str, source: str, target: str, column: str, numbers: DataFrame, day: str | None = None
) -> None:
    """The distinct values of a column by date, province and city as stored bitmaps, of one
    day or of all. `numbers` must hold every value."""
    rows = read_log(spark, source, log)
    rows = rows if day is None else rows.where(F.col("date") == day)
    sets = bitmaps.bitmaps(bitmaps.with_number(rows, column, numbers), G3, column)
    tables.write_bitmaps(sets, target)


def tag_search_job(
    spark: SparkSession, source: str, dictionary: DataFrame, target: str, now_ms: int
) -> None:
    """Tag index, posting lists and search documents of all rides, under `<target>`."""
    with scratch(spark):
        tags = written(usertags.user_tags(read_log(spark, source, "unlock"), dictionary), "user-tags")
        tables.write_tag_index(tags, f"{target}/index")
        numbers = bitmaps.numbered(tags.select("userid"))
        tables.write_numbers(numbers, f"{target}/numbers")
        tables.write_postings(tagindex.postings(tags, numbers), f"{target}/postings")
        tables.write_documents(usertags.tag_document(tags, now_ms), f"{target}/documents")


def live_job(
    spark: SparkSession, servers: str, log: str, path: str, checkpoint: str,
    max_per_batch: int | None = None,
) -> StreamingQuery:
    """The live rollups of one log from its Kafka topic."""
    return start_rollups(kafka_lines(spark, servers, log, max_per_batch), log, path, checkpoint)
