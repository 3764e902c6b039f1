"""Grouped reports declared as data.

A report counts or sums one log by date, province and city plus its own dimensions.
`report` is the plain aggregation. `report_suite` computes many reports of a log from a
single scan by grouping sets. Distinct counts take part if their values are numbered
(`bitmaps.with_number`): 64 numbers form a word, the word is one more grouping key, and the
numbers seen are the bits of one long, which tasks merge by OR before the shuffle. (A 4 KB
bitmap in every group of every report would be the larger buffer by far.)
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelens.functions.clock import utc_hour
from cyclelens.schemas import EVENT_TIME

G3 = ("date", "province", "city")


@dataclass(frozen=True)
class Metric:
    """`kind` is 'count', 'distinct' or 'sum'; `name` is the output column."""

    name: str
    kind: str
    column: str | None = None

    def over_rows(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1)).alias(self.name)
        if self.kind == "distinct":
            return F.countDistinct(self.column).alias(self.name)
        return F.sum(self.column).alias(self.name)


@dataclass(frozen=True)
class ReportSpec:
    name: str
    table: str
    log: str
    dims: tuple[str, ...]
    metrics: tuple[Metric, ...]
    where: tuple[str, int] | None = None  # (column, code) equality filter

    @property
    def keys(self) -> tuple[str, ...]:
        return (*G3, *self.dims)

    @property
    def additive(self) -> bool:
        return all(m.kind != "distinct" for m in self.metrics)

    @property
    def counted_values(self) -> tuple[str, ...]:
        """Columns whose distinct values this report counts."""
        return tuple(m.column for m in self.metrics if m.kind == "distinct")

    def inputs(self, df: DataFrame) -> set[str]:
        """Columns of the log that this report reads."""
        read = {c for c in self.keys if c != "hour"}
        read |= {m.column for m in self.metrics if m.column}
        if self.where:
            read.add(self.where[0])
        if "hour" in self.dims:
            read.add(_time_column(df, self.log))
        return read


def _time_column(df: DataFrame, log: str) -> str:
    # Ride reports accept the lock log too, whose only time is `timestamp`.
    name = EVENT_TIME[log]
    return name if name in df.columns or log != "unlock" else "timestamp"


def _check(df: DataFrame, spec: ReportSpec) -> None:
    missing = sorted(spec.inputs(df) - set(df.columns))
    if missing:
        raise ValueError(f"report {spec.name} needs columns the input lacks: {', '.join(missing)}")


def _with_hour(df: DataFrame, log: str, unit: str) -> DataFrame:
    time = _time_column(df, log)
    epoch = F.unix_millis(time) if dict(df.dtypes)[time] == "timestamp" else F.col(time)
    return df.withColumn("hour", utc_hour(epoch, unit))


def report(df: DataFrame, spec: ReportSpec, epoch_unit: str = "ms") -> DataFrame:
    """One report of one log: the keys of `spec`, then its metrics.

    `epoch_unit` says how the log's epoch numbers are read; 's' reads them as seconds.
    """
    _check(df, spec)
    if spec.where:
        column, code = spec.where
        df = df.where(F.col(column) == code)
    if "hour" in spec.dims:
        df = _with_hour(df, spec.log, epoch_unit)
    return df.groupBy(*spec.keys).agg(*[m.over_rows() for m in spec.metrics])


def report_suite(df: DataFrame, specs: list[ReportSpec], epoch_unit: str = "ms") -> DataFrame:
    """Many reports of one log from one scan and one shuffle.

    Returns every key, `set_id`, `n`, one sum per measure and, where distinct values are
    counted, `<column>_word` and `<column>_bits`: one row per group of every report. A
    report's filter column joins its grouping set and is filtered afterwards, so filtered
    and unfiltered reports share the scan. Slice a report off with `report_from_suite`.
    Partial aggregation keeps the shuffle at one row per group and map task, however large
    a single group is. Reports with distinct counts need the column `<column>_no`.
    """
    logs = {s.log for s in specs}
    if len(logs) != 1:
        raise ValueError("a suite takes reports of a single log")
    counted = sorted({c for s in specs for c in s.counted_values})
    plain = [f"{c}_no" for c in counted if f"{c}_no" not in df.columns]
    if plain:
        raise ValueError(f"distinct counts in a suite need numbered values: {', '.join(plain)}")
    for spec in specs:
        _check(df, spec)
    if any("hour" in s.dims for s in specs):
        df = _with_hour(df, specs[0].log, epoch_unit)
    for column in counted:
        number = F.col(f"{column}_no")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (number % 64).cast("int"))
        df = df.withColumns({f"{column}_word": F.call_function("div", number, F.lit(64)), f"{column}_bit": bit})

    sets = {s.name: _suite_keys(s) for s in specs}
    keys = list(dict.fromkeys(k for ks in sets.values() for k in ks))
    measures = sorted({m.column for s in specs for m in s.metrics if m.kind == "sum"})
    distinct_sets = list(dict.fromkeys(sets.values()))
    return df.groupingSets(
        [[F.col(k) for k in ks] for ks in distinct_sets], *[F.col(k) for k in keys]
    ).agg(
        F.grouping_id().alias("set_id"),
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"sum_{m}") for m in measures],
        *[F.bit_or(f"{c}_bit").alias(f"{c}_bits") for c in counted],
    )


def set_id(specs: list[ReportSpec], spec: ReportSpec) -> int:
    """Value of `set_id` that marks the rows of `spec` in the suite of `specs`."""
    keys = list(dict.fromkeys(k for s in specs for k in _suite_keys(s)))
    own = set(_suite_keys(spec))
    return reduce(lambda bits, key: bits * 2 + (key not in own), keys, 0)


def _suite_keys(spec: ReportSpec) -> tuple[str, ...]:
    extra = (spec.where[0],) if spec.where and spec.where[0] not in spec.keys else ()
    return (*spec.keys, *extra, *[f"{c}_word" for c in spec.counted_values])


def report_from_suite(suite: DataFrame, specs: list[ReportSpec], spec: ReportSpec) -> DataFrame:
    """The rows and columns of one report out of a suite table."""
    rows = suite.where(F.col("set_id") == set_id(specs, spec))
    if spec.where:
        column, code = spec.where
        rows = rows.where(F.col(column) == code)
    if not spec.additive:
        return rows.groupBy(*spec.keys).agg(*[
            F.coalesce(F.sum(F.bit_count(f"{m.column}_bits").cast("bigint")), F.lit(0)).alias(m.name) for m in spec.metrics
        ])
    metrics = [
        F.col("n" if m.kind == "count" else f"sum_{m.column}").alias(m.name) for m in spec.metrics
    ]
    return rows.select(*spec.keys, *metrics)
