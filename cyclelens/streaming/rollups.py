"""Running totals of the live logs.

One query per log parses each micro-batch once, groups it at the finest grain that any
of the log's rollups needs, and writes that partial under its batch id. A rollup is
read by summing partials over its own, coarser keys.

* A replayed batch overwrites its own partial, so restarts never count twice.
* Totals count events. Ride time is kept in whole milliseconds, so sums are exact
  whatever the order of the batches.
* There is no watermark: a late record adds to the keys of its own date.
* A key that was not written for two days expires; if it is written again later, its
  totals start anew.
* Lines are held to the rules of washing, for the fields that the rollups read: what is
  not one JSON object, or holds an unreadable value, or has no event time, is set aside
  with its reason.
* The job packs old partials by itself, so that the number of folders stays bounded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cyclelens.functions.clock import utc_date, utc_hour
from cyclelens.functions.coerce import to_epoch, to_type, unreadable
from cyclelens.operators.wash import REASON, one_object
from cyclelens.schemas import EPOCHS, EVENT_TIME, schema_of
from cyclelens.session import FREE_SHUFFLES, delete_folder, folder_names, settings

# Batch interval and idle expiry.
BATCH_INTERVAL = "5 seconds"
IDLE_SECONDS = 172_800

PACK_EVERY = 500  # batches


@dataclass(frozen=True)
class Rollup:
    name: str
    log: str
    keys: tuple[str, ...]


MEASURES = {"unlock": ("distance", "ride_ms"), "order": ("amount",),
             "recharge": ("amount",), "repair": ()}
_TEXTS = {"unlock": (), "order": ("rechargetype",), "recharge": ("rechargetype", "rechargesource"),
          "repair": ("repairtype",)}


def _rollups() -> dict[str, Rollup]:
    kinds = {
        "ride": ("unlock", {"total": "date", "hour": "date hour", "area": "date province city"}),
        "order": ("order", {"hour": "date hour", "area": "date province city",
                            "type": "date rechargetype"}),
        "recharge": ("recharge", {"hour": "date hour", "area": "date province city",
                                  "type": "date rechargetype", "source": "date rechargesource"}),
        "repair": ("repair", {"area": "date province city", "hour": "date hour",
                              "type": "date repairtype"}),
    }
    return {
        f"live_{kind}_{name}": Rollup(f"live_{kind}_{name}", log, tuple(keys.split()))
        for kind, (log, shapes) in kinds.items()
        for name, keys in shapes.items()
    }


ROLLUPS = _rollups()


def grain(log: str) -> tuple[str, ...]:
    """Keys of a partial: everything any rollup of the log groups by."""
    return ("date", "hour", "province", "city", *_TEXTS[log])


def _partial_schema(log: str) -> T.StructType:
    types = {f.name: f.dataType for f in schema_of(log)}
    types |= {"hour": T.StringType(), "ride_ms": T.LongType()}
    return T.StructType([
        *[T.StructField(k, types[k]) for k in grain(log)],
        T.StructField("total", T.LongType()),
        *[T.StructField(m, types[m]) for m in MEASURES[log]],
        T.StructField("first_written", T.TimestampType()),
        T.StructField("last_written", T.TimestampType()),
    ])


def parsed(lines: DataFrame, log: str) -> DataFrame:
    """Every raw line in `value` as the fields that the rollups need, plus `date`, `hour`
    and `reject_reason`, null if the line is good. `value` is kept."""
    time = EVENT_TIME[log]
    types = {f.name: f.dataType for f in schema_of(log)}
    wanted = ["province", "city", *_TEXTS[log], time]
    wanted += ["etimestamp", "distance"] if log == "unlock" else []
    wanted += ["amount"] if "amount" in MEASURES[log] else []
    text = T.StructType([T.StructField(name, T.StringType()) for name in wanted])

    def typed(line: Column) -> Column:
        # Epochs stay numbers here, also where the stored log has a timestamp.
        values = [
            (to_epoch(line[name]) if name in EPOCHS else to_type(line[name], types[name])).alias(name)
            for name in wanted
        ]
        return F.struct(line.alias("line"), F.struct(*values).alias("typed"))

    def judged(read: Column) -> Column:
        line, values = read["line"], read["typed"]
        reason = F.when(line.isNull(), "malformed")
        for name in wanted:
            if name in EPOCHS or not isinstance(types[name], T.StringType):
                reason = reason.when(unreadable(line[name], values[name]), f"bad_value:{name}")
            if name == time:
                reason = reason.when(values[name].isNull(), f"missing_value:{time}")
        return F.struct(*[values[name].alias(name) for name in wanted], reason.alias(REASON))

    # As in washing: parsed inside a generator, converted in a projection, which is compiled, and
    # a second generator keeps filters on the result from repeating either.
    read = lines.select("value", F.explode(one_object(F.col("value"), text)).alias("_line"))
    read = read.select("value", typed(F.col("_line")).alias("_line"))
    rows = read.select("value", F.inline(F.array(judged(F.col("_line")))))
    made = {"date": utc_date(F.col(time)), "hour": utc_hour(F.col(time))}
    if log == "unlock":
        made["ride_ms"] = F.try_subtract("etimestamp", time)
    return rows.withColumns(made)


def events(lines: DataFrame, log: str) -> DataFrame:
    """The fields that the rollups need, of the good lines among raw lines in `value`."""
    return parsed(lines, log).where(F.col(REASON).isNull()).drop("value", REASON)


def partial(lines: DataFrame, log: str) -> DataFrame:
    """One micro-batch of raw lines, summed up: totals at the finest grain for good lines
    (`status` good), and for bad lines (`status` bad) each text and reason with its number.

    Both come from one aggregation, so the lines are parsed once and kept nowhere."""
    rows = parsed(lines, log)
    bad = F.col(REASON).isNotNull()
    of_good = [F.when(~bad, F.col(k)).alias(k) for k in (*grain(log), *MEASURES[log])]
    of_bad = F.when(bad, F.col("value")).alias("value")
    marked = rows.select(*of_good, of_bad, REASON, F.when(bad, "bad").otherwise("good").alias("status"))
    return marked.groupBy("status", *grain(log), "value", REASON).agg(
        F.count(F.lit(1)).alias("total"), *[F.sum(m).alias(m) for m in MEASURES[log]]
    )


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def micros(moment: datetime) -> Column:
    """An instant as a timestamp column that does not depend on any time zone."""
    return F.timestamp_micros(F.lit(round(moment.timestamp() * 1_000_000)).cast("bigint"))


def start_rollups(
    lines: DataFrame,
    log: str,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    clock: Callable[[], datetime] = utc_now,
    pack_every: int = PACK_EVERY,
) -> StreamingQuery:
    """Start the live job of one log: `lines` is a stream with raw lines in `value`.

    Partials and bad lines go to `<path>/live/batch_id=N`, by `status`; progress is kept in
    `checkpoint`. Both must be folders that all executors share.
    `available_now` stops after the waiting data. Every `pack_every` batches the older
    ones, which can no longer be replayed, are packed. What a pack replaced is removed one
    pack later, so a reader has that long to finish.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, micros(clock())
        if batch_id and batch_id % pack_every == 0:
            replaced = packed_upto(spark, path)
            if replaced is None or replaced < batch_id - 1:
                pack(spark, log, path, batch_id - 1, clock())
                if replaced is not None:
                    drop_packed(spark, path, replaced)
        stamped = partial(batch, log).select("*", now.alias("first_written"), now.alias("last_written"))
        # Bad lines are long, so they are compressed well, and their shuffle goes once they are written.
        writer = stamped.write.mode("overwrite").option("compression", "zstd").partitionBy("status")
        with settings(spark, FREE_SHUFFLES):
            writer.parquet(f"{path}/live/batch_id={batch_id}")

    trigger = {"availableNow": True} if available_now else {"processingTime": BATCH_INTERVAL}
    return (
        lines.writeStream.queryName(f"live-{log}")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_partials(spark: SparkSession, log: str, path: str) -> DataFrame:
    """All partials of a log: the newest packed table and the complete batches after it.

    A batch that is being written, or written again, is left out until it is complete."""
    schema = _partial_schema(log)
    columns = [*schema.names, "batch_id"]
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    upto = packed_upto(spark, path)
    numbers = _batches(spark, path, finished=True)
    folders = [f"{path}/live/batch_id={n}" for n in numbers if upto is None or n > upto]
    live = _read_batches(spark, with_batch, f"{path}/live", folders, "good").select(*columns)
    if upto is None:
        return live
    packed = spark.read.schema(with_batch).parquet(f"{path}/packed/{_newest(spark, path)[2]}").select(*columns)
    return live.unionByName(packed)


def _read_batches(spark: SparkSession, schema: T.StructType, base: str, folders: list[str], status: str) -> DataFrame:
    """The rows of one status of some batches."""
    if not folders:
        return spark.createDataFrame([], schema)
    with_status = T.StructType([*schema.fields, T.StructField("status", T.StringType())])
    rows = spark.read.schema(with_status).option("basePath", base).parquet(*folders)
    return rows.where(F.col("status") == status)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The lines that the live job set aside: `value`, `reject_reason`, `batch_id`."""
    fields = [("value", T.StringType()), (REASON, T.StringType()), ("total", T.LongType()), ("batch_id", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    numbers = _batches(spark, path, finished=True)
    folders = [f"{path}/live/batch_id={n}" for n in numbers]
    kept = _read_batches(spark, schema, f"{path}/live", folders, "bad")
    times = F.sequence(F.lit(1).cast("long"), F.col("total"))
    return kept.select("value", REASON, "batch_id", F.explode(times)).select("value", REASON, "batch_id")


def read_rollup(
    spark: SparkSession, name: str, path: str, as_of: datetime | None = None
) -> DataFrame:
    """Current totals of one rollup: its keys, `total` and its measures.

    A key's writes that follow each other within the idle limit form one session; only
    the last session counts, and only if it has not run out at `as_of` (now).
    """
    rollup = ROLLUPS[name]
    alive = _sessions(read_partials(spark, rollup.log, path), rollup.log, rollup.keys)
    latest = alive.groupBy(*rollup.keys).agg(
        F.max_by(F.struct("total", *MEASURES[rollup.log]), "last_written").alias("t"),
        F.max("last_written").alias("last_written"),
    )
    deadline = F.col("last_written") + F.expr(f"interval {IDLE_SECONDS} seconds")
    return latest.where(deadline > micros(as_of or utc_now())).select(
        *rollup.keys, F.col("t.total").alias("total"), *_shown(rollup.log)
    )


def shown_measure(measure: str, value: Column) -> Column:
    """A measure as it is shown: ride time in hours."""
    if measure == "ride_ms":
        return (value / F.lit(3_600_000.0)).alias("time")
    return value.alias(measure)


def _shown(log: str) -> list[Column]:
    return [shown_measure(m, F.col(f"t.{m}")) for m in MEASURES[log]]


def _sessions(partials: DataFrame, log: str, keys: tuple[str, ...]) -> DataFrame:
    """Partials summed per key and per unbroken run of writes.

    A partial covers first_written … last_written and keeps its key alive for the idle
    limit after that."""
    span_micros = F.unix_micros("last_written") - F.unix_micros("first_written")
    alive_for = F.make_interval(
        secs=(span_micros / F.lit(1_000_000)).cast("decimal(18,6)") + F.lit(IDLE_SECONDS)
    )
    return partials.groupBy(*keys, F.session_window("first_written", alive_for)).agg(
        F.sum("total").alias("total"),
        *[F.sum(m).alias(m) for m in MEASURES[log]],
        F.min("first_written").alias("first_written"),
        F.max("last_written").alias("last_written"),
    )


def _batches(spark: SparkSession, path: str, finished: bool = False) -> list[int]:
    """Numbers of the batches under `path`; only completed writes if `finished`."""
    names = folder_names(spark, f"{path}/live/batch_id=*" + "/_SUCCESS" * finished)
    return sorted(int(name.split("=")[1]) for name in names)


def _packs(spark: SparkSession, path: str, finished: bool) -> list[tuple[int, int, str]]:
    """(last batch, run, folder name) of the packed tables `upto=N` and `upto=N.run`, the
    oldest first."""
    names = folder_names(spark, f"{path}/packed/upto=*" + "/_SUCCESS" * finished)
    parts = [(name.removeprefix("upto=").partition("."), name) for name in names]
    return sorted((int(n), int(run or 0), name) for (n, _, run), name in parts)


def _newest(spark: SparkSession, path: str) -> tuple[int, int, str] | None:
    done = _packs(spark, path, finished=True)
    return done[-1] if done else None


def packed_upto(spark: SparkSession, path: str) -> int | None:
    """Last batch held by the newest complete packed table."""
    newest = _newest(spark, path)
    return newest[0] if newest else None


def pack(
    spark: SparkSession, log: str, path: str, upto: int, as_of: datetime | None = None
) -> None:
    """Merge the partials of batches up to `upto` into one packed table.

    `upto` must be a batch that can no longer be replayed, that is, older than the last
    committed one. Rows of one key merge as long as the writes are unbroken, so no
    rollup changes. A date whose every key ran out is left out. Each call writes a folder of
    its own, also for an `upto` that was packed before, so a pack that fails loses nothing.
    Readers switch over when the packed table is complete; `drop_packed` then removes what
    it replaced. An `upto` older than the newest packed table changes nothing.
    """
    newest = _newest(spark, path)
    if newest and upto < newest[0]:
        return
    runs = [run for n, run, _ in _packs(spark, path, finished=False) if n == upto]
    name = f"upto={upto}.{max(runs) + 1}" if runs else f"upto={upto}"
    partials = read_partials(spark, log, path).where(F.col("batch_id") <= upto)
    merged = _sessions(partials, log, grain(log))
    # The key (date) outlives every finer key of the date, so it decides for all.
    dates = partials.groupBy("date").agg(F.max("last_written").alias("date_written"))
    deadline = F.col("date_written") + F.expr(f"interval {IDLE_SECONDS} seconds")
    kept = dates.where(deadline > micros(as_of or utc_now())).select("date")
    rows = merged.join(kept, "date", "left_semi").select(
        *_partial_schema(log).names, F.lit(upto).cast("bigint").alias("batch_id")
    )
    with settings(spark, FREE_SHUFFLES):
        rows.write.parquet(f"{path}/packed/{name}")


def drop_packed(spark: SparkSession, path: str, upto: int | None = None) -> None:
    """Remove the batches up to `upto` and the packed tables up to it, all of which the
    newest packed table replaced; without `upto`, everything that it replaced. Lines that
    were set aside stay.

    Queries that still read the old files must have ended."""
    newest = _newest(spark, path)
    if newest is None:
        return
    upto = newest[0] if upto is None else min(upto, newest[0])
    old = [f"{path}/packed/{name}" for n, run, name in _packs(spark, path, finished=False) if n <= upto and (n, run) < newest[:2]]
    for number in _batches(spark, path):
        if number <= upto:
            batch = f"{path}/live/batch_id={number}"
            old.append(f"{batch}/status=good" if folder_names(spark, f"{batch}/status=bad") else batch)
    for folder in old:
        delete_folder(spark, folder)
