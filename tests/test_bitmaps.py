"""Numbered values, bitmaps, posting lists, and distinct counts in the shared scan."""

import pytest
from pyspark.sql import functions as F

from cyclelens import fixtures
from cyclelens.operators import bitmaps, tagindex, usertags
from cyclelens.operators.reports import G3, report, report_suite
from cyclelens.plans import jobs
from cyclelens.plans.catalog import REPORTS, reports_of
from cyclelens.sinks import tables
from cyclelens.sources.logs import read_log
from tests.conftest import plan_of, rows


def test_numbers_are_kept_and_extended(spark):
    values = spark.createDataFrame([("a",), ("b",), (None,), ("a",), ("",)], "v string")
    first = bitmaps.numbered(values)
    known = {r.value: r.number for r in first.collect()}
    assert set(known) == {"a", "b", ""} and len(set(known.values())) == 3 and min(known.values()) >= 1
    more = bitmaps.numbered(spark.createDataFrame([("b",), ("c",)], "v string"), first)
    both = {r.value: r.number for r in more.collect()}
    assert {k: both[k] for k in known} == known and both["c"] > max(known.values())
    assert rows(bitmaps.numbered(values.where("false"))) == []


def test_members_give_the_numbers_back(spark):
    numbers = [1, 2, 63, 64, 65, 32_768, 32_769, 70_000, 5_000_000_000]
    df = spark.createDataFrame([("x", n) for n in numbers] + [("y", 7), ("y", 7), ("z", None)], "k string, v_no long")
    sets = bitmaps.bitmaps(df, ("k",), "v")
    assert rows(bitmaps.members(sets)) == sorted([("x", n) for n in numbers] + [("y", 7)], key=repr)
    assert rows(bitmaps.counted(sets, ("k",), "n")) == [("x", 9), ("y", 1)]
    both = bitmaps.any_of(sets, ())
    assert bitmaps.members(both).count() == 10
    assert rows(bitmaps.members(bitmaps.all_of(sets, (), 2))) == []


def test_all_ten_ride_reports_come_from_one_scan(spark, rides, tmp_path):
    tables.write_log(rides, str(tmp_path / "log"))
    log = read_log(spark, str(tmp_path / "log"), "unlock")
    numbered = jobs.numbered_log(log, ("userid", "bikeid"))
    specs = reports_of("unlock")
    plan = plan_of(report_suite(numbered, specs))
    assert plan.count("FileScan parquet [") - plan.count("numbers-") == 1 and plan.count("Expand") == 1
    assert "btimestamp" in plan and "sessionid" not in plan  # only the columns that are counted
    for spec, got in jobs.all_reports(numbered, "unlock").items():
        assert rows(got) == rows(report(log, spec)), spec.name
    assert not any("number" in c for c in log.columns)
    with pytest.raises(ValueError, match="userid_no"):
        report_suite(log, [REPORTS["day_peo_bike"]])


def test_distinct_payments_in_their_suite(spark, sf_dir):
    log = fixtures.load(spark, sf_dir, "recharge")
    numbered = jobs.numbered_log(log, ("userid",))
    found = jobs.all_reports(numbered, "recharge")
    spec = REPORTS["day_peo_recharge"]
    assert rows(found[spec]) == rows(report(log, spec))


def test_a_day_of_bitmaps_replaces_itself(spark, rides, tmp_path):
    tables.write_log(rides, str(tmp_path / "log"), by_date=True)
    numbers = bitmaps.numbered(rides.select("userid"))
    target = str(tmp_path / "sets")
    for day in (None, "2024-01-03", "2024-01-03"):
        jobs.bitmap_job(spark, "unlock", str(tmp_path / "log"), target, "userid", numbers, day)
    stored = spark.read.schema("province string, city string, bucket long, bits binary, date string").parquet(target)
    assert rows(bitmaps.counted(stored, G3, "usersum")) == rows(report(rides, REPORTS["day_peo_bike"]))
    whole = bitmaps.counted(bitmaps.any_of(stored, ()), (), "n").first()[0]
    assert whole == rides.select("userid").distinct().count()


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    users = [(f"u{i}", tag, 1 + i) for i in range(3000) for tag, step in (("all", 1), ("two", 2), ("three", 3), ("rare", 997)) if i % step == 0]
    tags = spark.createDataFrame(users, "userid string, tag string, cnt long")
    numbers = bitmaps.numbered(tags.select("userid"))
    tables.write_numbers(numbers, f"{folder}/numbers")
    tables.write_postings(tagindex.postings(tags, numbers), f"{folder}/postings")
    return tags, spark.read.parquet(f"{folder}/postings"), spark.read.parquet(f"{folder}/numbers")


@pytest.mark.parametrize("match", ["all", "any"])
@pytest.mark.parametrize("wanted", [["two"], ["two", "three"], ["rare", "three", "rare"], ["two", "missing"], ["missing"]])
def test_search_agrees_with_the_long_table(index, wanted, match):
    tags, postings, numbers = index
    got = tagindex.users_by_tag(postings, numbers, wanted, match)
    assert rows(got) == rows(usertags.users_by_tag(tags, wanted, match))


def test_search_reads_the_wanted_lists_only(index):
    tags, postings, numbers = index
    plan = plan_of(tagindex.search(postings, ["rare"]))
    assert "PushedFilters: [" in plan and "EqualTo(tag,rare)" in plan.replace("In(tag, [rare])", "EqualTo(tag,rare)")
    with pytest.raises(ValueError):
        tagindex.search(postings, ["a"], "some")


def test_registered_search_does_not_read_the_rides(spark, sf_dir):
    import __spark_entry__ as entry_module

    plan = plan_of(entry_module.queries()["users_by_tag"](spark, sf_dir))
    assert "lineitem" not in plan and "postings" in plan and "numbers" in plan
