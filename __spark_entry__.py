"""Entry points for the checks: a flagship query, every query, and its SQL twin."""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable, Iterator
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cyclelens import fixtures, oracle  # noqa: E402
from cyclelens.functions.geo import geohash8  # noqa: E402
from cyclelens.functions.tags import business_tags, client_tags, ride_tags  # noqa: E402
from cyclelens.operators import bitmaps, decay, geodict, tagindex, usertags  # noqa: E402
from cyclelens.operators.reports import G3, ReportSpec, report, report_suite  # noqa: E402
from cyclelens.operators.wash import mask, split_valid, wash  # noqa: E402
from cyclelens.plans.catalog import REPORTS, reports_of  # noqa: E402
from cyclelens.plans.jobs import all_reports  # noqa: E402
from cyclelens.plans.standing import StandingTags  # noqa: E402
from cyclelens.schemas import LOGS  # noqa: E402
from cyclelens.session import delete_folder, settings, work_folder, written  # noqa: E402
from cyclelens.sinks import tables  # noqa: E402
from cyclelens.sources.logs import stream_lines  # noqa: E402
from cyclelens.streaming import state  # noqa: E402
from cyclelens.streaming.rollups import ROLLUPS, read_rejects, read_rollup, start_rollups  # noqa: E402



def _training_data_queries():
    """The queries of the training-data package, or None where its folders are absent."""
    try:
        importlib.import_module("corpus_pipeline")
        return importlib.import_module("cyclelens.llm.entries")
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "cyclelens.llm", "cyclelens.llm.entries"):
            raise
        return None


_LLM = _training_data_queries()
_NOW_MS = 1706745600000
_AS_OF = "2024-02-01"
_HALF_LIFE_DAYS = 7.0
_DAILY = ("userid", "date")


def entry(spark: SparkSession) -> DataFrame:
    """Rides per hour and city on the smallest test tables."""
    return _report(REPORTS["hour_peo_bike"], spark, "/root/testdata/sf0.001")


def _report(spec: ReportSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(fixtures.load(spark, sf_dir, spec.log), spec)


def _wash(log: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    washed = wash(fixtures.rough_lines(fixtures.load(spark, sf_dir, log)), log)
    if log == "lock":  # shown as an epoch, which reads the same in every engine
        washed = washed.withColumn("timestamp", F.unix_millis("timestamp"))
    return washed


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fixtures.damaged_lines(fixtures.load(spark, sf_dir, "unlock"))
    return split_valid(lines, "unlock")[1].select("line_id", "reject_reason")


def _masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = fixtures.addresses(fixtures.load(spark, sf_dir, "unlock"))
    return mask(rides, salt="fixture-salt").select("sessionid", "userid", "ip", "mac")


def _geohash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = fixtures.load(spark, sf_dir, "unlock")
    return rides.select("sessionid", geohash8(F.col("latitude"), F.col("longitude")).alias("geohash8"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geodict.distinct_points(fixtures.load(spark, sf_dir, "unlock"))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geodict.decode_replies(fixtures.load(spark, sf_dir, "replies"))


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = written(_points(spark, sf_dir), "points")
    return geodict.geo_dictionary(points, fixtures.replies_to(spark, points))


def _misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geodict.geo_misses(_points(spark, sf_dir), _dictionary(spark, sf_dir))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of the eastern points, completed with the replies to its misses."""
    points = written(_points(spark, sf_dir), "points")
    replies = fixtures.replies_to(spark, points)
    known = written(geodict.geo_dictionary(points.where("longitude >= 100"), replies), "dictionary")
    return geodict.completed_dictionary(points, known, replies)


def _stored_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(_dictionary(spark, sf_dir), "dictionary")


def _ride_tags(tags: Callable, spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = fixtures.load(spark, sf_dir, "unlock")
    return rides.select("sessionid", "userid", F.array_join(F.array_sort(tags()), ",").alias("tags"))


def _district_tags(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    rides = fixtures.load(spark, sf_dir, "unlock").select(
        "sessionid", "userid", "latitude", "longitude"
    )
    placed = usertags.with_districts(rides, _stored_dictionary(spark, sf_dir), **how)
    tags = F.array_join(F.array_sort(business_tags(F.col("business"))), ",")
    return placed.select("sessionid", "userid", tags.alias("tags"))


def _stored_rides(spark: SparkSession, sf_dir: str, *columns: str | Column) -> tuple[DataFrame, DataFrame]:
    """What tags read of the rides, with `columns`, and the dictionary of their points. Both
    are stored: the tables are joined to rides once, however often the rides are read."""
    rides = fixtures.load(spark, sf_dir, "unlock").select(*columns, *usertags.TAGGED)
    rides = written(rides, "rides")
    points = written(geodict.distinct_points(rides), "points")
    return rides, written(geodict.geo_dictionary(points, fixtures.replies_to(spark, points)), "dictionary")


def _user_tags(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ("userid",), **how) -> DataFrame:
    return usertags.user_tags(*_stored_rides(spark, sf_dir, *keys), keys, **how)


def _detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usertags.tag_detail(usertags.tag_lists(*_stored_rides(spark, sf_dir, *_DAILY), _DAILY))


def _document(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = usertags.tag_document(_user_tags(spark, sf_dir), _NOW_MS)
    # A map has no order, so it is shown as sorted text.
    text = F.map_entries("tags").cast("array<struct<tag:string,cnt:int>>")
    return documents.select("id", "timestamp", usertags.tag_text(text).alias("tags"))


_indexes: dict[tuple[str, str], str] = {}


def _tag_index(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the stored posting lists and numbers. A session builds them once; searches
    read them and not the rides."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _indexes:
        folder = work_folder(spark, "tag-index")
        tags = written(_user_tags(spark, sf_dir), "user-tags")
        numbers = bitmaps.numbered(tags.select("userid"))
        tables.write_numbers(numbers, f"{folder}/numbers")
        tables.write_postings(tagindex.postings(tags, numbers), f"{folder}/postings")
        _indexes[key] = folder
    return _indexes[key]


def _users_by_tag(spark: SparkSession, sf_dir: str, match: str = "all") -> DataFrame:
    folder = _tag_index(spark, sf_dir)
    index, numbers = (spark.read.parquet(f"{folder}/{part}") for part in ("postings", "numbers"))
    return tagindex.users_by_tag(index, numbers, ["LNiphone", "LS蓝牙", "BSd3"], match)


def _decayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = _user_tags(spark, sf_dir, _DAILY)
    weights = usertags.tag_decay(daily, _AS_OF, _HALF_LIFE_DAYS)
    return weights.withColumn("weight", F.round("weight", 6))


def _forward_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stores with landmarks of their own, merged, then asked for the same day."""
    daily = written(_user_tags(spark, sf_dir, _DAILY), "daily-tags")
    middle = "2024-01-15"
    parts = [
        written(decay.forward_weights(daily.where(days), landmark, _HALF_LIFE_DAYS), "tag-weights")
        for days, landmark in ((F.col("date") < middle, "2023-12-01"), (F.col("date") >= middle, middle))
    ]
    store = decay.merged(parts, middle, _HALF_LIFE_DAYS)
    weights = decay.weights_at(store, _AS_OF, _HALF_LIFE_DAYS)
    return weights.withColumn("weight", F.round("weight", 6))


def _standing_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts of the month merged in any order, one of them twice: first with half of
    its rides, then with all."""
    part = F.expr("cast(right(date, 2) as int) div 10").alias("part")
    half = (F.pmod(F.xxhash64("sessionid"), F.lit(2)) == 0).alias("half")
    rides, words = _stored_rides(spark, sf_dir, "userid", part, half)
    # Parts and halves are kept apart as days are, so the districts are looked up once.
    tags = written(usertags.user_tags(rides, words, ("userid", "part", "half")), "part-tags")
    standing = StandingTags(spark, work_folder(spark, "standing"), buckets=8)
    for number, chosen in ((2, F.lit(True)), (0, F.col("half")), (1, F.lit(True)), (0, F.lit(True))):
        # By user, a row or two for each tag: what follows needs no other exchange.
        of_part = tags.where((F.col("part") == number) & chosen).repartition("userid")
        standing.merge(f"part{number}", of_part.groupBy("userid", "tag").agg(F.sum("cnt").alias("cnt")))
    return standing.tags()


def _stored_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District tags of rides from rides and dictionary in buckets, joined where they lie."""
    rides = fixtures.load(spark, sf_dir, "unlock").select("sessionid", "userid", "latitude", "longitude")
    folder, buckets = work_folder(spark, "districts"), 8
    usertags.write_cells(rides, f"{folder}/cells", buckets)
    usertags.write_districts(_dictionary(spark, sf_dir), f"{folder}/words", buckets)
    placed = usertags.with_stored_districts(spark, f"{folder}/cells", f"{folder}/words", rides.schema, buckets)
    tags = F.array_join(F.array_sort(business_tags(F.col("business"))), ",")
    return placed.select("sessionid", "userid", tags.alias("tags"))


def _detail_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored detail of some users, looked up by key."""
    folder = work_folder(spark, "detail")
    # Ranges are found in a pass of their own, which would compute the detail once more.
    tables.write_detail(written(_detail(spark, sf_dir), "detail-rows"), folder)
    return tables.detail_of(spark, folder, ["1", "7", "25", "nobody"])


def _user_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by date, province and city as stored bitmaps, written in two runs."""
    rides = fixtures.load(spark, sf_dir, "unlock").select(*G3, "userid")
    numbers, folder = bitmaps.numbered(rides.select("userid")), work_folder(spark, "user-bitmaps")
    sets = bitmaps.bitmaps(bitmaps.with_number(rides, "userid", numbers), G3, "userid")
    for days in (F.col("date") < _MIDDLE, F.col("date") >= _MIDDLE):
        tables.write_bitmaps(sets.where(days), folder)
    schema = "province string, city string, bucket bigint, bits binary, date string"
    return spark.read.schema(schema).parquet(folder)


_MIDDLE = "2024-01-15"
_CITY = ("province", "city")


def _month_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different users of the whole month, merged from the days' bitmaps."""
    return bitmaps.counted(bitmaps.any_of(_user_bitmaps(spark, sf_dir), _CITY), _CITY, "usersum")


def _returning_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of both halves of the month."""
    half = F.col("date") < _MIDDLE
    halves = bitmaps.any_of(_user_bitmaps(spark, sf_dir).withColumn("half", half), (*_CITY, "half"))
    return bitmaps.counted(bitmaps.all_of(halves, _CITY, 2), _CITY, "usersum").where("usersum > 0")


def _all_ride_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten ride reports from one stored log, as one table: `report`, keys, `dims`, `value`.

    Users and bikes are counted from their own columns: numbers made for this one use would
    cost a join of all rides for each."""
    log = fixtures.load(spark, sf_dir, "unlock")
    rides = written(log.select(*sorted(set().union(*[s.inputs(log) for s in reports_of("unlock")]))), "rides")
    shown = []
    for spec, rows in all_reports(rides, "unlock").items():
        dims = F.concat_ws("|", *[F.col(d).cast("string") for d in spec.dims])
        value = F.col(spec.metrics[0].name).cast("double").alias("value")
        shown.append(rows.select(F.lit(spec.name).alias("report"), *G3, dims.alias("dims"), value))
    return reduce(DataFrame.unionByName, shown)


def _suite(log: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = [s for s in reports_of(log) if s.additive]
    return report_suite(fixtures.load(spark, sf_dir, log), shared)


# Turns in which a log is sent to a live job.
_TURNS = 2


def _sent(log: DataFrame, to_lines: Callable[[DataFrame], DataFrame], folder: str, batches: int) -> Iterator[int]:
    """Sends a log to `folder` as raw lines, for a stream in `batches` batches: stores a turn of
    them, yields how many files make a batch, and removes them when the caller is done.

    Raw lines take a multiple of the disk of the tables they come from, and the join that
    makes them shuffles these tables; so only one turn of both is on disk at a time."""
    for turn in range(_TURNS):
        part = log.where(F.pmod(F.xxhash64("sessionid"), F.lit(_TURNS)) == turn)
        yield tables.write_lines(to_lines(part), f"{folder}/turn={turn}", batches // _TURNS, kind="parquet")
        delete_folder(log.sparkSession, f"{folder}/turn={turn}")


def _streamed(log_df: DataFrame, to_lines: Callable[[DataFrame], DataFrame], label: str, log: str) -> str:
    """Raw lines streamed in four batches; the folder with the totals. The job packs the
    first two batches on its way."""
    spark = log_df.sparkSession
    folder = work_folder(spark, label)
    for files in _sent(log_df, to_lines, f"{folder}/in", batches=4):
        start_rollups(
            stream_lines(spark, f"{folder}/in", files, kind="parquet"), log, f"{folder}/totals",
            f"{folder}/checkpoint", available_now=True, pack_every=2,
        ).awaitTermination()
    return f"{folder}/totals"


def _live(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    log = ROLLUPS[name].log
    rows = fixtures.load(spark, sf_dir, log)
    return read_rollup(spark, name, _streamed(rows, fixtures.raw_lines, name, log))


def _live_state(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running totals of a rollup from the state store."""
    rows = fixtures.load(spark, sf_dir, ROLLUPS[name].log)
    folder = work_folder(spark, name)
    for files in _sent(rows, fixtures.raw_lines, f"{folder}/in", batches=2):
        with settings(spark, state.state_settings()):
            stream = stream_lines(spark, f"{folder}/in", files, kind="parquet")
            state.start_state_rollup(stream, name, f"{folder}/state", available_now=True).awaitTermination()
    return state.read_state_rollup(spark, name, f"{folder}/state")


def _live_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = fixtures.load(spark, sf_dir, "unlock")
    rejects = read_rejects(spark, _streamed(rides, fixtures.damaged_lines, "live-rejects", "unlock"))
    line_id = F.regexp_extract("value", '"sessionid":"([^"]*)"', 1).alias("line_id")
    return rejects.select(line_id, "reject_reason")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **{name: partial(_report, spec) for name, spec in REPORTS.items()},
        **{f"wash_{log}": partial(_wash, log) for log in LOGS},
        "wash_rejects": _rejects,
        "mask_sensitive": _masked,
        "geohash8": _geohash,
        "distinct_points": _points,
        "geocode_decode": _decoded,
        "geo_dictionary": _dictionary,
        "geo_misses": _misses,
        "tags_client": partial(_ride_tags, client_tags),
        "tags_bike": partial(_ride_tags, ride_tags),
        "geo_dictionary_merged": _merged,
        "tags_business": _district_tags,
        "tags_business_shuffled": partial(_district_tags, broadcast_bytes=0),
        "user_tags": _user_tags,
        "user_tags_shuffled": partial(_user_tags, broadcast_bytes=0),
        "user_tag_detail": _detail,
        "user_tag_document": _document,
        "users_by_tag": _users_by_tag,
        "users_by_any_tag": partial(_users_by_tag, match="any"),
        "tag_decay": _decayed,
        "tag_decay_forward": _forward_decay,
        "user_tags_standing": _standing_tags,
        "tags_business_stored": _stored_districts,
        "user_tag_detail_of": _detail_of_users,
        "month_peo_bike": _month_users,
        "returning_peo_bike": _returning_users,
        "all_ride_reports": _all_ride_reports,
        **{f"report_suite_{log}": partial(_suite, log) for log in ("unlock", "order", "recharge", "repair")},
        **{name: partial(_live, name) for name in ROLLUPS},
        **{f"{name}_state": partial(_live_state, name) for name in ("live_ride_hour", "live_recharge_source")},
        "live_rejects": _live_rejects,
        **(_LLM.queries() if _LLM else {}),
    }


def oracle_sql() -> dict[str, str]:
    return oracle.all_sql() | (_LLM.oracle_sql() if _LLM else {})
