import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from cyclelens import fixtures
from cyclelens.functions.geo import geohash8
from cyclelens.operators import geodict, lookup, usertags
from tests.conftest import plan_of, rows

CLIENT = {1: "LNiphone", 2: "LNandroid", 3: "LN小程序"}
DEVICE = {1: "LCiphone", 2: "LCandroid", 3: "LCwp"}
NETWORK = {1: "LFwifi", 2: "LF4G", 3: "LF3G"}
UNLOCK = {1: "LS扫码", 2: "LS蓝牙"}


@pytest.fixture(scope="module")
def dictionary(spark, sf_dir):
    return entry_module._stored_dictionary(spark, sf_dir)


@pytest.fixture(scope="module")
def expected(rides, dictionary):
    """Tag counts per (user, date), ride by ride in plain Python."""
    names = {r.geohash8: r.business for r in dictionary.collect()}
    cells = rides.withColumn("cell", geohash8(F.col("latitude"), F.col("longitude"))).collect()
    counts = Counter()
    for r in cells:
        if not r.userid:
            continue
        tags = {CLIENT.get(r.client), DEVICE.get(r.deviceType), NETWORK.get(r.networkingmannerid),
                UNLOCK.get(r.unlock)}
        tags.add("LA短程" if r.distance <= 1000 else "LA中程" if r.distance < 2000 else "LA长程")
        if 3 < r.latitude < 54 and 73 < r.longitude < 136:
            tags |= {"BS" + n for n in (names.get(r.cell) or "").split(",") if n}
        for tag in tags - {None}:
            counts[r.userid, r.date, tag] += 1
    return counts


def per_user(expected):
    total = Counter()
    for (user, _, tag), n in expected.items():
        total[user, tag] += n
    return total


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_user_tags(rides, dictionary, expected, limit):
    got = usertags.user_tags(rides, dictionary, broadcast_bytes=limit)
    assert {(r.userid, r.tag): r.cnt for r in got.collect()} == dict(per_user(expected))
    assert got.columns == ["userid", "tag", "cnt"]


def test_daily_tags_detail_and_wide_form(rides, dictionary, expected):
    daily = usertags.user_tags(rides, dictionary, ("userid", "date")).persist()
    assert {(r.userid, r.date, r.tag): r.cnt for r in daily.collect()} == dict(expected)

    detail = usertags.tag_detail(daily)
    texts = {(r.userid, r.day): r.tags for r in detail.collect()}
    want = {}
    for (user, day, tag), n in sorted(expected.items(), key=lambda e: e[0][2].encode()):
        want.setdefault((user, day), []).append(f"{tag}:{n}")
    assert texts == {k: ",".join(v) for k, v in want.items()}

    lists = usertags.tag_lists(rides, dictionary, ("userid", "date"))
    assert rows(usertags.tag_detail(lists)) == rows(detail)
    # Neither side of the join that builds the lists is shuffled again for it.
    assert plan_of(lists).count("Exchange hashpartitioning(userid") == 4

    day = "2024-01-03"
    assert rows(usertags.tag_detail(lists, day)) == rows(detail.where(F.col("day") == day))
    assert rows(usertags.tag_detail(daily, day)) == rows(detail.where(F.col("day") == day))
    wide = usertags.detail_wide(detail, ["2024-01-03", "2024-01-04"])
    assert wide.columns == ["userid", "day 2024-01-03", "day 2024-01-04"]
    for row in wide.collect():
        assert row[1] == texts.get((row.userid, "2024-01-03"))
        assert row[2] == texts.get((row.userid, "2024-01-04"))
    daily.unpersist()


def test_documents(rides, dictionary, expected):
    documents = usertags.tag_document(usertags.user_tags(rides, dictionary), 123)
    lists = usertags.tag_document(usertags.tag_lists(rides, dictionary), 123)
    assert {r.id: r.tags for r in lists.collect()} == {r.id: r.tags for r in documents.collect()}
    want = {}
    for (user, tag), n in per_user(expected).items():
        want.setdefault(user, {})[tag] = n
    got = {r.id: r.tags for r in documents.collect()}
    assert got == want
    assert dict(documents.dtypes) == {"id": "string", "timestamp": "bigint", "tags": "map<string,bigint>"}


def test_search(rides, dictionary, expected):
    tags = usertags.user_tags(rides, dictionary).persist()
    have = {}
    for (user, tag), n in per_user(expected).items():
        have.setdefault(user, {})[tag] = n
    carriers = Counter(tag for t in have.values() for tag in t if tag.startswith("BS"))
    district = min(carriers, key=lambda tag: (abs(carriers[tag] - len(have) / 2), tag))
    wanted = ["LNiphone", district, district]
    both = {u for u, t in have.items() if "LNiphone" in t and district in t}
    either = {u for u, t in have.items() if "LNiphone" in t or district in t}
    often = {u for u, t in have.items() if t.get("LNiphone", 0) >= 12}
    assert both and both != either
    users = lambda df: {r.userid for r in df.collect()}
    assert users(usertags.users_by_tag(tags, wanted)) == both
    assert users(usertags.users_by_tag(tags, wanted, match="any")) == either
    assert users(usertags.users_by_tag(tags, ["LNiphone"], min_count=12)) == often
    with pytest.raises(ValueError):
        usertags.users_by_tag(tags, wanted, match="most")
    tags.unpersist()


def test_decay(spark):
    daily = spark.createDataFrame(
        [("u", "2024-01-01", "a", 4), ("u", "2024-01-08", "a", 1), ("u", "2024-01-10", "a", 9),
         ("v", "2024-01-08", "b", 3)], "userid string, date string, tag string, cnt long")
    got = {(r.userid, r.tag): r.weight for r in usertags.tag_decay(daily, "2024-01-08", 7).collect()}
    assert got == {("u", "a"): 3.0, ("v", "b"): 3.0}
    later = usertags.tag_decay(daily, "2024-01-10", 2).collect()
    assert math.isclose({r.tag: r.weight for r in later}["b"], 1.5)


def test_empty_and_null_users_are_left_out(spark, rides):
    odd = rides.withColumn("userid", F.when(F.col("userid") != "7", F.col("userid")))
    users = {r.userid for r in usertags.fixed_tag_counts(odd).collect()}
    assert users and "" not in users and None not in users and "7" not in users


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_every_ride_keeps_its_row(rides, dictionary, limit):
    placed = usertags.with_districts(rides, dictionary, broadcast_bytes=limit)
    assert sorted(placed.columns) == sorted([*rides.columns, "business"])
    assert placed.count() == rides.count()
    assert rows(placed.select("sessionid", "business")) == rows(
        usertags.with_districts(rides, dictionary).select("sessionid", "business"))


@pytest.fixture
def small_partitions(spark):
    """Adaptive execution as on large data, at a size where a test shows it."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_hot_and_null_keys_are_spread(spark, small_partitions):
    """A third of the rows on one key and a third on null: same answer, many tasks."""
    facts = spark.range(60_000).repartition(8).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id")).alias("key"))
    words = spark.createDataFrame([("hot", "H"), ("k1", "one"), ("k4", "four"), ("zz", "none")],
                                  "key string, word string")
    small = lookup.lookup(facts, words, "key")
    large = lookup.lookup(facts, words, "key", broadcast_bytes=0)
    assert large.where("word = 'H'").count() == 20_000
    assert large.count() == 60_000
    same = small.select("id", "key", "word").exceptAll(large.select("id", "key", "word"))
    assert same.isEmpty()
    large.collect()
    assert "skew=true" in plan_of(large)


def test_large_dictionary_is_not_broadcast(spark, rides, dictionary):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(usertags.with_districts(rides, dictionary, broadcast_bytes=0))
        last_join = plan.index("Join")
        assert plan[:last_join].endswith("SortMerge")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_cell_with_several_replies(spark):
    near = [(39.90421, 116.40741), (39.90422, 116.40742)]  # the same cell
    points = spark.createDataFrame([*near, (30.0, 100.0), (31.0, 101.0)], "latitude double, longitude double")
    reply = 'renderReverse&&renderReverse({"result":{"business":"%s","pois":[]}})'
    replies = spark.createDataFrame(
        [(*near[0], reply % "low"), (*near[1], reply % "high"), (30.0, 100.0, reply % "")],
        "latitude double, longitude double, reply string")
    made = geodict.geo_dictionary(points, replies)
    assert [r.business for r in made.collect()] == ["high"]
    # A reply that names nothing does not hide the one that does.
    silent = replies.withColumn("reply", F.when(F.col("latitude") == near[1][0], reply % "").otherwise(F.col("reply")))
    assert [r.business for r in geodict.geo_dictionary(points, silent).collect()] == ["low"]
    missing = {(r.latitude, r.longitude) for r in geodict.geo_misses(points, made).collect()}
    assert missing == {(30.0, 100.0), (31.0, 101.0)}
    blank = made.withColumn("business", F.lit(""))
    assert {(r.latitude, r.longitude) for r in geodict.geo_misses(points, blank).collect()} == missing | {near[1]}


def test_merge_dictionary(spark):
    known = spark.createDataFrame([("a", "1"), ("b", "2")], "geohash8 string, business string")
    fresh = spark.createDataFrame([("b", "3"), ("c", "4")], "geohash8 string, business string")
    assert rows(geodict.merge_dictionary(known, fresh)) == [("a", "1"), ("b", "3"), ("c", "4")]


def test_distinct_points(spark):
    df = spark.createDataFrame([(10.0, 80.0), (10.0, 80.0), (3.0, 80.0), (None, 80.0)],
                               "latitude double, longitude double")
    assert rows(geodict.distinct_points(df)) == [(10.0, 80.0)]


def test_bounds_reach_the_scan(spark, sf_dir, tmp_path):
    fixtures.load(spark, sf_dir, "unlock").write.parquet(str(tmp_path / "log"))
    plan = plan_of(geodict.distinct_points(spark.read.parquet(str(tmp_path / "log"))))
    assert "GreaterThan(latitude,3.0)" in plan and "LessThan(longitude,136.0)" in plan
    assert "userid" not in plan
    tags = plan_of(usertags.fixed_tag_counts(spark.read.parquet(str(tmp_path / "log"))))
    assert "Not(EqualTo(userid,))" in tags and "latitude" not in tags
    assert tags.index("Expand") < tags.index("Exchange")  # rows are multiplied after the shuffle


def test_one_busy_user_and_one_busy_cell(spark, rides, dictionary):
    """A user with a third of all rides, and a cell with another third of them."""
    place = rides.where(F.col("latitude") < 50).select("latitude", "longitude").first()
    third = F.pmod(F.xxhash64("sessionid"), F.lit(3))
    skewed = rides.withColumns({
        "userid": F.when(third == 0, "busy").otherwise(F.col("userid")),
        "latitude": F.when(third == 1, place.latitude).otherwise(F.col("latitude")),
        "longitude": F.when(third == 1, place.longitude).otherwise(F.col("longitude")),
    })
    small = usertags.user_tags(skewed, dictionary)
    large = usertags.user_tags(skewed, dictionary, broadcast_bytes=0)
    assert rows(small) == rows(large)
    ways = small.where("userid = 'busy' and tag like 'LS%'").agg(F.sum("cnt")).first()[0]
    assert ways == skewed.where("userid = 'busy'").count() > rides.count() / 4
