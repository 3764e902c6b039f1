from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cyclelens.functions import clock, geo, masking, tags
from tests.conftest import rows

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def halving(lat, lon):
    """Geohash by repeated halving, straight from its definition."""
    sides = {"lon": [-180.0, 180.0], "lat": [-90.0, 90.0]}
    value = {"lon": lon, "lat": lat}
    bits = ""
    for i in range(40):
        axis = "lat" if i % 2 else "lon"
        low, high = sides[axis]
        middle = (low + high) / 2
        upper = value[axis] >= middle
        sides[axis] = [middle, high] if upper else [low, middle]
        bits += "1" if upper else "0"
    return "".join(ALPHABET[int(bits[i:i + 5], 2)] for i in range(0, 40, 5))


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("millis, hour, date", [
    (1546308000000, "2", "2019-01-01"),
    (0, "0", "1970-01-01"),
    (1704067199999, "23", "2023-12-31"),
    (1704067200000, "0", "2024-01-01"),
    (1709251199000, "23", "2024-02-29"),
    (-1, "23", "1969-12-31"),
    (None, None, None),
])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_hour_and_date_are_utc_in_any_session_zone(spark, millis, hour, date, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        epoch = F.lit(millis).cast("bigint")
        assert one(spark, clock.utc_hour(epoch)) == hour
        assert one(spark, clock.utc_date(epoch)) == date
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hour_reads_seconds_on_request(spark):
    assert one(spark, clock.utc_hour(F.lit(1546308000000), "s")) == "8"
    with pytest.raises(ValueError):
        clock.utc_hour(F.lit(0), "minutes")


@settings(max_examples=30, deadline=None)
@given(st.datetimes(min_value=datetime(1960, 1, 1), max_value=datetime(2100, 1, 1)))
def test_hour_matches_the_calendar(spark, moment):
    moment = moment.replace(tzinfo=timezone.utc, microsecond=0)
    epoch = F.lit(int(moment.timestamp()) * 1000)
    assert one(spark, clock.utc_hour(epoch)) == str(moment.hour)
    assert one(spark, clock.utc_date(epoch)) == moment.strftime("%Y-%m-%d")


def test_ride_hours(spark):
    begin, end = F.lit(1704067200000), F.lit(1704067200000 + 5_400_000)
    assert one(spark, clock.ride_hours(begin, end)) == 1.5


def test_geohash_known_value(spark):
    assert one(spark, geo.geohash8(F.lit(39.9042), F.lit(116.4074))) == "wx4g0bm6"


def test_geohash_matches_halving(spark):
    import math
    import random

    draw = random.Random(7)
    points = [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(5000)]
    borders = [(-90 + 180 * draw.randrange(1 << 20) / (1 << 20),
                -180 + 360 * draw.randrange(1 << 20) / (1 << 20)) for _ in range(1000)]
    points += borders
    points += [(math.nextafter(a, -100), math.nextafter(b, -200)) for a, b in borders if a > -90 and b > -180]
    points += [(math.nextafter(a, 100), math.nextafter(b, 200)) for a, b in borders]
    points += [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (-0.0, -0.0), (5e-324, -5e-324)]
    df = spark.createDataFrame(points, "lat double, lon double")
    got = df.select("lat", "lon", geo.geohash8(F.col("lat"), F.col("lon"))).collect()
    wrong = [(a, b, g) for a, b, g in got if g != halving(a, b)]
    assert not wrong


def test_geohash_of_no_place(spark):
    df = spark.createDataFrame(
        [(None, 1.0), (1.0, None), (91.0, 1.0), (1.0, 181.0), (float("nan"), 1.0)], "lat double, lon double")
    assert [r[0] for r in df.select(geo.geohash8(F.col("lat"), F.col("lon"))).collect()] == [None] * 5


def test_bounds_are_strict(spark):
    points = [(3.0, 80.0), (54.0, 80.0), (10.0, 73.0), (10.0, 136.0), (None, 80.0), (10.0, None),
              (3.0001, 73.0001), (53.9999, 135.9999)]
    df = spark.createDataFrame(points, "lat double, lon double")
    assert rows(df.where(geo.in_bounds(F.col("lat"), F.col("lon")))) == [points[6], points[7]]


@pytest.mark.parametrize("reply, business", [
    ('renderReverse&&renderReverse({"result":{"business":"a,b","pois":[{"tag":"x"}]}})', "a,b"),
    ('renderReverse&&renderReverse({"result":{"business":"","pois":[{"tag":"x"},{"tag":"y"}]}})', "x"),
    ('renderReverse&&renderReverse({"result":{"business":"","pois":[]}})', None),
    ('renderReverse&&renderReverse({"result":{"business":"","pois":[{"tag":""}]}})', None),
    ('renderReverse&&renderReverse({"result":{"business":"f(x)","pois":[]}})', "f(x)"),
    ('renderReverse&&renderReverse({"result":\n{"business":"two lines"}})', "two lines"),
    ('{"result":{"business":"a"}}', None),
    ("renderReverse&&renderReverse(", None),
    ("", None),
    (None, None),
])
def test_decode_reply(spark, reply, business):
    df = spark.createDataFrame([(reply,)], "reply string")
    assert df.select(geo.decode_reply(F.col("reply"))).first()[0] == business


RIDE = "client int, deviceType int, networkingmannerid int, unlock int, distance double"


@pytest.mark.parametrize("ride, client, trip", [
    ((1, 1, 1, 1, 10.0), ["LNiphone", "LCiphone", "LFwifi"], ["LS扫码", "LA短程"]),
    ((2, 2, 2, 2, 1000.0), ["LNandroid", "LCandroid", "LF4G"], ["LS蓝牙", "LA短程"]),
    ((3, 3, 3, 1, 1000.5), ["LN小程序", "LCwp", "LF3G"], ["LS扫码", "LA中程"]),
    ((0, 9, None, 3, 2000.0), [], ["LA长程"]),
    ((None, None, 3, None, None), ["LF3G"], []),
])
def test_ride_and_client_tags(spark, ride, client, trip):
    df = spark.createDataFrame([ride], RIDE)
    assert df.select(tags.client_tags()).first()[0] == client
    assert df.select(tags.ride_tags()).first()[0] == trip
    held = [t for t, hit in tags.fixed_tag_rules().items() if df.select(hit).first()[0]]
    assert sorted(held) == sorted(client + trip)


@pytest.mark.parametrize("districts, expected", [
    ("a,b", ["BSa", "BSb"]), ("a,a", ["BSa"]), ("a,,b,,", ["BSa", "BSb"]), ("", []), (None, []),
])
def test_business_tags(spark, districts, expected):
    df = spark.createDataFrame([(districts,)], "d string")
    assert df.select(tags.business_tags(F.col("d"))).first()[0] == expected


def test_masking(spark):
    df = spark.createDataFrame(
        [("u1", "10.0.3.7"), ("u1", "2001:db8:1:2::9"), ("", ""), (None, None)], "u string, ip string")
    got = df.select(masking.pseudonym(F.col("u"), "s"), masking.blur_ip(F.col("ip"))).collect()
    assert got[0][0] == got[1][0] and len(got[0][0]) == 64
    assert [r[0] for r in got[2:]] == ["", None]
    assert [r[1] for r in got] == ["10.0.3.*", "2001:db8:1:*", "", None]
    assert df.select(masking.pseudonym(F.col("u"), "other")).first()[0] != got[0][0]


@pytest.mark.parametrize("ip, blurred", [
    ("10.0.3.7", "10.0.3.*"), (" 10.0.3.7 ", "10.0.3.*"), ("10.0.0.7:80", "10.0.0.*"),
    ("fe80::1", "fe80::*"), ("::1", "::*"), ("::ffff:10.0.0.7", "::*"), ("fe80::1%eth0", "fe80::*"),
    ("[2001:db8:1:2::9]:443", "2001:db8:1:*"), ("2001:db8:1:2:3:4:5:6", "2001:db8:1:*"),
    ("2001:db8::9", "2001:db8::*"), ("host-7", "*"), ("10.0.0", "*"), ("1.2.3.4.5", "*"),
    ("fe80", "*"), ("", ""), ("  ", ""), (None, None),
])
def test_no_address_stays_whole(spark, ip, blurred):
    df = spark.createDataFrame([(ip,)], "ip string")
    assert df.select(masking.blur_ip(F.col("ip"))).first()[0] == blurred


def test_salt_is_not_shown_in_plans(spark, capsys):
    from cyclelens.session import SALT_IN_PLAN
    spark.conf.set("spark.sql.redaction.string.regex", SALT_IN_PLAN)
    try:
        df = spark.range(3).select(F.col("id").cast("string").alias("u"))
        masked = df.select(masking.pseudonym(F.col("u"), "top-secret-salt"))
        for mode in ("simple", "extended", "formatted"):
            masked.explain(mode)
        shown = capsys.readouterr().out
        assert "sha2" in shown and "top-secret-salt" not in shown
    finally:
        spark.conf.unset("spark.sql.redaction.string.regex")


@pytest.mark.parametrize("epoch", [9223372036854775807, -9223372036854775808, 253402300800000])
def test_extreme_epochs_do_not_fail(spark, epoch):
    df = spark.createDataFrame([(epoch,)], "t long")
    df.select(clock.utc_date(F.col("t")), clock.utc_hour(F.col("t"))).collect()


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-Infinity", "1e999", "nan"])
def test_numbers_are_finite(spark, text):
    from pyspark.sql import types as T
    from cyclelens.functions.coerce import to_type, unreadable
    df = spark.createDataFrame([(text,)], "v string")
    for kind in (T.DoubleType(), T.LongType(), T.IntegerType()):
        value = to_type(F.col("v"), kind)
        assert tuple(df.select(value, unreadable(F.col("v"), value)).first()) == (None, True)
