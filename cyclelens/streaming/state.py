"""Running totals in the state store.

The other form of the live totals (`rollups`) keeps a partial table for each batch and sums
them on reading. Here the totals themselves are the state of the stream: each key holds one
row in Spark's state store, updated by every batch and expired by the store when it was not
written for two days. A reader looks the totals up in the store's last committed version, so
there is nothing to list, to merge or to pack.

* Before the shuffle each task sums its part of a batch by key, so a key that holds a third
  of all lines arrives as one row of each task.
* State and offsets are committed together: a batch that is run again starts from the state
  before it, and counts once.
* A key that ran out starts anew with its next line.

The store needs the RocksDB provider, which `state_settings` names; a session sets these
before the job starts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from cyclelens.streaming.rollups import (
    BATCH_INTERVAL, IDLE_SECONDS, MEASURES, ROLLUPS, Rollup, events, micros, shown_measure, utc_now,
)
from cyclelens.schemas import schema_of

# What runs in tasks is sent with its code, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE = "totals"


def state_settings() -> dict[str, str]:
    """Session settings that the job needs. A batch without lines would only look for idle
    keys, which a reader leaves out anyway, and would keep a job from ending."""
    return {
        "spark.sql.streaming.stateStore.providerClass": PROVIDER,
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }


def _key_fields(rollup: Rollup) -> list[T.StructField]:
    types = {f.name: f.dataType for f in schema_of(rollup.log)} | {"hour": T.StringType()}
    return [T.StructField(k, types[k]) for k in rollup.keys]


def _sum_fields(rollup: Rollup) -> list[T.StructField]:
    types = {f.name: f.dataType for f in schema_of(rollup.log)} | {"ride_ms": T.LongType()}
    # How many values a sum is made of tells a sum of nothing, which is null, from zero.
    return [T.StructField("total", T.LongType()), *[
        field for m in MEASURES[rollup.log]
        for field in (T.StructField(m, types[m]), T.StructField(f"n_{m}", T.LongType()))
    ]]


def _adder(keys: tuple[str, ...], sums: list[str]):
    """Sums one Arrow batch by key."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate([(s, "sum") for s in sums])
                yield from table.rename_columns([c.removesuffix("_sum") for c in table.column_names]).select(
                    [*keys, *sums]
                ).to_batches()

    return add


class _Totals(StatefulProcessor):
    """Adds the sums of a batch to those of a key; the store forgets idle keys."""

    def __init__(self, keys: list[str], sums: T.StructType, idle_ms: int) -> None:
        self.keys, self.sums, self.idle_ms = keys, sums, idle_ms

    def init(self, handle) -> None:
        self.state = handle.getValueState(_STATE, self.sums, self.idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names = self.sums.names
        now = list(self.state.get()) if self.state.exists() else [0] * len(names)
        for part in rows:
            now = [a + part[name].sum() for a, name in zip(now, names)]
        now = [int(v) if isinstance(f.dataType, T.LongType) else float(v) for v, f in zip(now, self.sums.fields)]
        self.state.update(tuple(now))
        yield pd.DataFrame([[*key, *now]], columns=[*self.keys, *names]).astype(
            {f.name: "int64" if isinstance(f.dataType, T.LongType) else "float64" for f in self.sums.fields}
        )

    def close(self) -> None:
        pass


def running_totals(lines: DataFrame, name: str, idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """The stream of updated totals of a rollup, from a stream of raw lines in `value`."""
    rollup = ROLLUPS[name]
    sums = T.StructType(_sum_fields(rollup))
    measures = [
        column for m in MEASURES[rollup.log]
        for column in (F.coalesce(m, F.lit(0)).alias(m), F.col(m).isNotNull().cast("long").alias(f"n_{m}"))
    ]
    good = events(lines, rollup.log).select(*rollup.keys, F.lit(1).cast("long").alias("total"), *measures)
    schema = T.StructType([*_key_fields(rollup), *sums.fields])
    partial = good.mapInArrow(_adder(rollup.keys, sums.names), schema)
    return partial.groupBy(*rollup.keys).transformWithStateInPandas(
        statefulProcessor=_Totals(list(rollup.keys), sums, idle_seconds * 1000),
        outputStructType=schema, outputMode="Update", timeMode="ProcessingTime",
    )


def start_state_rollup(
    lines: DataFrame, name: str, checkpoint: str, available_now: bool = False, idle_seconds: int = IDLE_SECONDS
) -> StreamingQuery:
    """Start the live job of one rollup: `lines` is a stream with raw lines in `value`. Its
    totals live in `checkpoint`, a folder that all executors share."""
    trigger = {"availableNow": True} if available_now else {"processingTime": BATCH_INTERVAL}
    return (
        running_totals(lines, name, idle_seconds)
        .writeStream.queryName(f"state-{name}")
        .outputMode("update")
        .format("noop")  # the state is the result
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_state_rollup(spark: SparkSession, name: str, checkpoint: str, as_of: datetime | None = None) -> DataFrame:
    """Current totals of one rollup: its keys, `total` and its measures, of the keys that
    have not run out at `as_of` (now)."""
    rollup = ROLLUPS[name]
    state = spark.read.format("statestore").option("stateVarName", _STATE).load(checkpoint)
    alive = F.col("value.ttlExpirationMs") > F.unix_millis(micros(as_of or utc_now()))
    found = state.where(alive).select(*[F.col(f"key.{k}").alias(k) for k in rollup.keys], "value.value.*")
    return found.select(*rollup.keys, "total", *[_shown(m) for m in MEASURES[rollup.log]])


def _shown(measure: str) -> Column:
    total = F.when(F.col(f"n_{measure}") > 0, F.col(measure))
    return shown_measure(measure, total)
