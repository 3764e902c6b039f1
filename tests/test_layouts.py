"""Stored layouts: buckets, partitions by date, detail by user."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cyclelens import fixtures
from cyclelens.operators import usertags
from cyclelens.plans import jobs
from cyclelens.sinks import tables
from cyclelens.sinks.buckets import read_bucketed, write_bucketed
from cyclelens.sources.logs import read_log
from tests.conftest import plan_of, rows


def test_buckets_keep_rows_and_need_no_exchange(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id % 97 as string) as k", "id as v")
    more = spark.range(50).selectExpr("cast(id as string) as k", "id * 2 as w")
    for name, table in (("a", df), ("b", more)):
        write_bucketed(table, str(tmp_path / name), ("k",), 4)
    a, b = (read_bucketed(spark, str(tmp_path / n), t.schema, ("k",), 4) for n, t in (("a", df), ("b", more)))
    assert rows(a) == rows(df)
    joined = a.join(b.hint("merge"), "k")
    assert "Exchange" not in plan_of(joined)
    assert rows(joined) == rows(df.join(more, "k"))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_stored_districts_join_without_exchange(spark, rides, tmp_path):
    some = rides.select("sessionid", "userid", "latitude", "longitude")
    some = some.withColumn("latitude", F.when(F.crc32("sessionid") % 3 > 0, 30.25).otherwise(F.col("latitude")))
    words = some.select(usertags.ride_cell().alias("geohash8")).distinct().where("geohash8 is not null")
    words = words.withColumn("business", F.concat(F.lit("d"), F.col("geohash8")))
    usertags.write_cells(some, str(tmp_path / "cells"), 4)
    usertags.write_districts(words, str(tmp_path / "words"), 4)
    got = usertags.with_stored_districts(spark, str(tmp_path / "cells"), str(tmp_path / "words"), some.schema, 4)
    assert "Exchange" not in plan_of(got)
    assert rows(got) == rows(usertags.with_districts(some, words))


def rows_read(df):
    """Rows that the scans of an executed plan gave out."""
    df._jdf.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    scans, total = [plan], 0
    while scans:
        node = scans.pop()
        if "FileSourceScan" in node.getClass().getName():
            total += node.metrics().apply("numOutputRows").value()
        scans += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.fixture(scope="module")
def detail(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("detail"))
    made = spark.range(60_000).selectExpr(
        "concat('u', id % 20000) as userid", "concat('2024-01-0', 1 + id div 20000) as day",
        "concat('tag', md5(cast(id as string)), ':', id % 9) as tags")
    tables.write_detail(made, path, group_bytes=64 << 10)
    return path, made


def test_detail_of_some_users_reads_few_row_groups(spark, detail):
    path, made = detail
    got = tables.detail_of(spark, path, ["u77", "u19999", "nobody"])
    assert rows(got) == rows(made.where("userid in ('u77', 'u19999')"))
    groups = [pq.ParquetFile(os.path.join(d, f)).metadata.num_row_groups
              for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert sum(groups) >= 24
    assert rows_read(got) < 60_000 / 3
    one_day = tables.detail_of(spark, path, ["u77"], ["2024-01-02"])
    assert "2024-01-02" in plan_of(one_day).split("PartitionFilters: [")[1].split("]")[0]
    assert one_day.count() == 1 and rows_read(one_day) <= rows_read(tables.detail_of(spark, path, ["u77"]))


def test_absent_user_is_found_missing_by_the_filter(spark, detail):
    path, _ = detail
    # Within the range of every file's users, so only the Bloom filters can tell.
    assert rows_read(tables.detail_of(spark, path, ["u5x"])) < 60_000 / 4


def test_detail_days_are_replaced(spark, tmp_path):
    path = str(tmp_path)
    two = spark.createDataFrame([("a", "2024-01-01", "t:1"), ("b", "2024-01-02", "t:2")], "userid string, day string, tags string")
    tables.write_detail(two, path)
    tables.write_detail(two.where("userid = 'b'").withColumn("tags", F.lit("t:9")), path)
    assert rows(tables.detail_of(spark, path, ["a", "b"])) == [("a", "2024-01-01", "t:1"), ("b", "2024-01-02", "t:9")]


def test_washed_log_is_read_by_day(spark, rides, tmp_path):
    lines = fixtures.damaged_lines(rides).select("value")
    lines.write.text(str(tmp_path / "raw"))
    jobs.wash_job(spark, "unlock", str(tmp_path / "raw"), str(tmp_path / "washed"))
    good = str(tmp_path / "washed/status=good")
    days = sorted(n for n in os.listdir(good) if n.startswith("date="))
    assert len(days) == 28
    assert all(len([f for f in os.listdir(f"{good}/{d}") if f.endswith(".parquet")]) == 1 for d in days)
    one = jobs.rides_of(spark, good, "2024-01-03")
    plan = plan_of(one.select("userid"))
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-03" in plan
    assert rows_read(one.select("userid")) == one.count()
    kind = F.expr("btimestamp div 1000 % 22")
    want = rides.where(~kind.isin(0, 1, 2, 3, 5, 6, 7, 8, 9, 10))
    assert rows(read_log(spark, good, "unlock").select("sessionid", "date")) == rows(want.select("sessionid", "date"))
    rejected = spark.read.option("basePath", str(tmp_path / "washed")).parquet(str(tmp_path / "washed/status=rejected"))
    assert rejected.count() == rides.count() - want.count()
