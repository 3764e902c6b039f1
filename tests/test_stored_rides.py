"""Registered queries join the tables to rides once, and read districts once."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from cyclelens import fixtures, session
from cyclelens.functions.tags import business_tags
from cyclelens.operators import bitmaps, tagindex, usertags
from tests.conftest import plan_of, rows


def counted(monkeypatch, module, name):
    """The arguments of every call of a function from here on."""
    calls, function = [], getattr(module, name)

    def counting(*args, **how):
        calls.append(args)
        return function(*args, **how)

    monkeypatch.setattr(module, name, counting)
    return calls


@pytest.mark.parametrize("name", ["users_by_tag", "user_tag_detail_of", "user_tags_standing", "user_tag_detail", "tag_decay_forward"])
def test_rides_are_joined_once(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(entry_module, "_indexes", {})
    loads, lookups = counted(monkeypatch, fixtures, "load"), counted(monkeypatch, usertags, "lookup")
    entry_module.queries()[name](spark, sf_dir)
    assert [view for _, _, view in loads] == ["unlock"]
    assert len(lookups) == 1


def test_detail_is_computed_before_its_ranges(spark, sf_dir, monkeypatch):
    writes = counted(monkeypatch, entry_module.tables, "write_detail")
    entry_module.queries()["user_tag_detail_of"](spark, sf_dir)
    plan = plan_of(writes[0][0])
    assert "FileScan" in plan and "Join" not in plan and "Aggregate" not in plan


def test_ride_reports_number_nothing(spark, sf_dir, monkeypatch):
    labels = counted(monkeypatch, session, "work_folder")
    got = entry_module.queries()["all_ride_reports"](spark, sf_dir)
    assert [label for _, label in labels] == ["rides", "suite-unlock"]
    assert got.select("report").distinct().count() == 10


def test_postings_make_each_bitmap_once(spark):
    tags = spark.createDataFrame([(f"u{i}", f"t{i % 3}", 1) for i in range(50)], "userid string, tag string, cnt long")
    postings = tagindex.postings(tags, bitmaps.numbered(tags.select("userid")))
    gathered = plan_of(postings).split("Exchange hashpartitioning(tag", 1)
    assert len(gathered) == 2 and "bitmap_construct_agg" not in gathered[1]
    assert rows(bitmaps.counted(postings, ("tag",), "n")) == [("t0", 17), ("t1", 17), ("t2", 16)]


def test_district_counts_follow_the_tags_of_a_list(spark):
    lists = [None, "", ",", "a", "a,a", "a,,b", "b,a,"]
    rides = spark.createDataFrame(
        [("u", 10.0 + i, 80.0, i) for i in range(len(lists))], "userid string, latitude double, longitude double, at int"
    )
    words = rides.join(spark.createDataFrame(list(enumerate(lists)), "at int, business string"), "at")
    words = words.select(usertags.ride_cell().alias("geohash8"), "business")
    want = words.select(F.explode(business_tags(F.col("business"))).alias("tag")).groupBy("tag").count()
    got = usertags.district_tag_counts(rides, words).select("tag", "cnt")
    assert rows(got) == rows(want) == [("BSa", 4), ("BSb", 2)]
