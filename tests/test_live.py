import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cyclelens import fixtures
from cyclelens.sources.kafka import TOPICS, kafka_lines, kafka_options
from cyclelens.sources.logs import stream_lines
from cyclelens.streaming.rollups import (
    IDLE_SECONDS, ROLLUPS, drop_packed, events, pack, packed_upto, read_partials, read_rejects,
    read_rollup, start_rollups,
)
from tests.conftest import rows

NOW = datetime(2024, 3, 1, tzinfo=timezone.utc)
DAY = timedelta(days=1)


def run(spark, log, folder, clock=lambda: NOW, files_per_batch=1):
    job = start_rollups(
        stream_lines(spark, f"{folder}/in", files_per_batch), log, f"{folder}/out",
        f"{folder}/checkpoint", available_now=True, clock=clock)
    assert job.awaitTermination(120)
    return job


def batches(folder):
    return sorted(int(n.split("=")[1]) for n in os.listdir(f"{folder}/out/live"))


def send(spark, folder, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode(
        "append").text(f"{folder}/in")


def ride(begin=1704067200000, minutes=30, distance=100.0, city="c"):
    return ('{"province":"p","city":"%s","btimestamp":%d,"etimestamp":%d,"distance":%s}'
            % (city, begin, begin + minutes * 60000, distance))


@pytest.fixture(scope="module")
def four_files(spark, rides, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("live"))
    fixtures.raw_lines(rides).repartition(4).write.text(f"{folder}/in")
    run(spark, "unlock", folder)
    return folder


def test_names():
    assert len(ROLLUPS) == 13
    assert ROLLUPS["live_recharge_source"].keys == ("date", "rechargesource")


def test_four_batches_add_up_to_the_batch_answer(spark, rides, four_files):
    assert batches(four_files) == [0, 1, 2, 3]
    for name in ("live_ride_total", "live_ride_hour", "live_ride_area"):
        got = read_rollup(spark, name, f"{four_files}/out", NOW)
        made = events(fixtures.raw_lines(rides), "unlock")
        want = made.groupBy(*ROLLUPS[name].keys).agg(
            F.count("*").alias("total"), F.sum("distance").alias("distance"),
            (F.sum("ride_ms") / F.lit(3600000.0)).alias("time"))
        assert rows(got) == rows(want)
        assert got.agg(F.sum("total")).first()[0] == rides.count()


def test_restart_and_replay_do_not_count_twice(spark, four_files):
    before = rows(read_rollup(spark, "live_ride_hour", f"{four_files}/out", NOW))
    run(spark, "unlock", four_files)
    assert rows(read_rollup(spark, "live_ride_hour", f"{four_files}/out", NOW)) == before
    # Without its commit record the last batch runs again, under its own id.
    for record in ("3", ".3.crc"):
        os.remove(f"{four_files}/checkpoint/commits/{record}")
    run(spark, "unlock", four_files)
    assert batches(four_files) == [0, 1, 2, 3]
    assert rows(read_rollup(spark, "live_ride_hour", f"{four_files}/out", NOW)) == before


def test_packing_changes_no_rollup(spark, four_files):
    out = f"{four_files}/out"
    before = {n: rows(read_rollup(spark, n, out, NOW)) for n in ("live_ride_total", "live_ride_area")}
    pack(spark, "unlock", out, 1, NOW)
    assert packed_upto(spark, out) == 1
    pack(spark, "unlock", out, 2, NOW)
    assert packed_upto(spark, out) == 2
    assert {n: rows(read_rollup(spark, n, out, NOW)) for n in before} == before
    drop_packed(spark, out)
    assert batches(four_files) == [3]
    assert os.listdir(f"{out}/packed") == ["upto=2"]
    assert {n: rows(read_rollup(spark, n, out, NOW)) for n in before} == before


def test_unfinished_pack_is_ignored(spark, four_files):
    out = f"{four_files}/out"
    done = packed_upto(spark, out)
    os.makedirs(f"{out}/packed/upto=99")
    assert packed_upto(spark, out) == done


def test_counts_events_not_batches(spark, tmp_path):
    folder = str(tmp_path)
    send(spark, folder, ride(), ride(distance=50.5), ride(city="d"))
    run(spark, "unlock", folder)
    send(spark, folder, ride(minutes=15))
    run(spark, "unlock", folder)
    got = rows(read_rollup(spark, "live_ride_area", f"{folder}/out", NOW))
    assert got == [("2024-01-01", "p", "c", 3, 250.5, 1.25), ("2024-01-01", "p", "d", 1, 100.0, 0.5)]


def test_bad_lines_and_late_lines(spark, tmp_path):
    folder = str(tmp_path)
    old = ride(begin=1600000000000)
    send(spark, folder, ride(), "{bad", "", '{"btimestamp":"soon"}', '{"btimestamp":"1704067200000"}')
    run(spark, "unlock", folder)
    send(spark, folder, old)  # years late: adds to its own date
    run(spark, "unlock", folder)
    assert rows(read_rollup(spark, "live_ride_total", f"{folder}/out", NOW)) == [
        ("2020-09-13", 1, 100.0, 0.5), ("2024-01-01", 2, 100.0, 0.5)]


def test_hour_and_date_of_a_ride_across_midnight(spark, tmp_path):
    folder = str(tmp_path)
    send(spark, folder, ride(begin=1704153599000, minutes=60))
    run(spark, "unlock", folder)
    assert rows(read_rollup(spark, "live_ride_hour", f"{folder}/out", NOW)) == [
        ("2024-01-01", "23", 1, 100.0, 1.0)]


def test_idle_keys_expire_and_start_anew(spark, tmp_path):
    folder, out = str(tmp_path), f"{tmp_path}/out"
    send(spark, folder, ride(city="a"), ride(city="b"))
    run(spark, "unlock", folder, clock=lambda: NOW)
    send(spark, folder, ride(city="a"))
    run(spark, "unlock", folder, clock=lambda: NOW + 1.5 * DAY)

    def totals(as_of, name="live_ride_area"):
        return [r[-3] for r in rows(read_rollup(spark, name, out, as_of))]

    assert totals(NOW + 1.6 * DAY) == [2, 1]
    assert totals(NOW + 2.5 * DAY) == [2]  # b ran out, a was refreshed
    assert totals(NOW + 2.5 * DAY, "live_ride_total") == [3]  # the date's own key lives on
    assert totals(NOW + timedelta(days=1.5, seconds=IDLE_SECONDS - 1)) == [2]
    assert totals(NOW + timedelta(days=1.5, seconds=IDLE_SECONDS)) == []

    send(spark, folder, ride(city="a"), ride(city="b"))
    run(spark, "unlock", folder, clock=lambda: NOW + 3 * DAY)
    assert totals(NOW + 3 * DAY) == [3, 1]  # b starts from nothing
    assert totals(NOW + 3 * DAY, "live_ride_total") == [5]

    for upto in (1, 2):  # packing keeps all of this
        pack(spark, "unlock", out, upto, NOW + 3 * DAY)
        assert totals(NOW + 3 * DAY) == [3, 1]
        assert totals(NOW + 3 * DAY, "live_ride_total") == [5]
    pack(spark, "unlock", out, 2, NOW + 9 * DAY)
    assert read_partials(spark, "unlock", out).where("batch_id <= 2").isEmpty()


def test_packing_the_same_batches_again_loses_nothing(spark, tmp_path):
    folder, out = str(tmp_path), f"{tmp_path}/out"
    for _ in range(3):
        send(spark, folder, ride())
        run(spark, "unlock", folder)
    want = rows(read_rollup(spark, "live_ride_total", out, NOW))
    pack(spark, "unlock", out, 1, NOW)
    drop_packed(spark, out)  # what was packed is now in the packed table only
    os.makedirs(f"{out}/packed/upto=1.1")  # a second pack that failed half way
    assert packed_upto(spark, out) == 1
    assert rows(read_rollup(spark, "live_ride_total", out, NOW)) == want
    pack(spark, "unlock", out, 1, NOW)
    assert sorted(os.listdir(f"{out}/packed")) == ["upto=1", "upto=1.1", "upto=1.2"]
    assert rows(read_rollup(spark, "live_ride_total", out, NOW)) == want
    drop_packed(spark, out)
    assert os.listdir(f"{out}/packed") == ["upto=1.2"]
    pack(spark, "unlock", out, 0, NOW)  # older than what is packed
    assert os.listdir(f"{out}/packed") == ["upto=1.2"]
    assert rows(read_rollup(spark, "live_ride_total", out, NOW)) == want


def test_rejects_outlive_packing(spark, tmp_path):
    folder, out = str(tmp_path), f"{tmp_path}/out"
    for _ in range(2):
        send(spark, folder, ride(), "{bad", "{bad")
        run(spark, "unlock", folder)
    pack(spark, "unlock", out, 1, NOW)
    drop_packed(spark, out)
    assert rows(read_rejects(spark, out)) == [("{bad", "malformed", 0)] * 2 + [("{bad", "malformed", 1)] * 2
    assert rows(read_rollup(spark, "live_ride_total", out, NOW)) == [("2024-01-01", 2, 200.0, 1.0)]


def test_money_rollups(spark, tmp_path):
    folder = str(tmp_path)
    line = '{"province":"p","city":"c","timestamp":1704067200000,"rechargetype":%s,"rechargesource":%s,"amount":%s}'
    send(spark, folder, line % (1, 3, 2.5), line % ('"1"', 2, '"4"'), line % (2, 3, "null"))
    run(spark, "recharge", folder)
    out = f"{folder}/out"
    assert rows(read_rollup(spark, "live_recharge_type", out, NOW)) == [
        ("2024-01-01", 1, 2, 6.5), ("2024-01-01", 2, 1, None)]
    assert rows(read_rollup(spark, "live_recharge_source", out, NOW)) == [
        ("2024-01-01", 2, 1, 4.0), ("2024-01-01", 3, 2, 2.5)]


def test_kafka_settings(spark):
    assert TOPICS == {"unlock": "bike_unlock", "order": "bike_order", "recharge": "bike_recharge",
                      "repair": "bike_repair"}
    options = kafka_options("host:1", "order", 10)
    assert options["subscribe"] == "bike_order" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "10"
    with pytest.raises(Exception, match="(?i)kafka"):  # the connector is not installed here
        kafka_lines(spark, "host:1", "order")


def test_no_line_stops_the_stream_or_spoils_a_sum(spark, tmp_path):
    folder = str(tmp_path)
    bad = {
        ride(begin=9223372036854775807, minutes=0): "bad_value:btimestamp",
        ride(distance='"NaN"'): "bad_value:distance",
        ride(distance='"Infinity"'): "bad_value:distance",
        ride() + " junk": "malformed", ride() + ride(): "malformed", "": "malformed",
        '{"btimestamp":"soon"}': "bad_value:btimestamp", '{"city":"c"}': "missing_value:btimestamp",
    }
    send(spark, folder, ride(), *bad)
    run(spark, "unlock", folder)
    assert rows(read_rollup(spark, "live_ride_total", f"{folder}/out", NOW)) == [("2024-01-01", 1, 100.0, 0.5)]
    assert rows(read_rejects(spark, f"{folder}/out")) == sorted(
        ((line, why, 0) for line, why in bad.items()), key=repr)
    code = '{"province":"p","city":"c","timestamp":1704067200000,"repairtype":"broken"}'
    send(spark, f"{folder}/repair", code)
    run(spark, "repair", f"{folder}/repair")
    assert rows(read_rejects(spark, f"{folder}/repair/out")) == [(code, "bad_value:repairtype", 0)]
    assert rows(read_rollup(spark, "live_repair_type", f"{folder}/repair/out", NOW)) == []


def test_incomplete_batch_is_not_read(spark, tmp_path):
    folder = str(tmp_path)
    for _ in range(2):
        send(spark, folder, ride())
        run(spark, "unlock", folder)
    os.remove(f"{folder}/out/live/batch_id=1/_SUCCESS")
    assert rows(read_rollup(spark, "live_ride_total", f"{folder}/out", NOW)) == [("2024-01-01", 1, 100.0, 0.5)]
    os.remove(f"{folder}/out/live/batch_id=0/_SUCCESS")
    assert rows(read_rollup(spark, "live_ride_total", f"{folder}/out", NOW)) == []


def test_live_job_packs_by_itself(spark, tmp_path):
    folder = str(tmp_path)
    for _ in range(7):
        send(spark, folder, ride())
    job = start_rollups(
        stream_lines(spark, f"{folder}/in", 1), "unlock", f"{folder}/out", f"{folder}/checkpoint",
        available_now=True, clock=lambda: NOW, pack_every=2)
    job.awaitTermination()
    assert packed_upto(spark, f"{folder}/out") == 5
    assert batches(folder) == [4, 5, 6]  # what the last pack replaced goes with the next one
    assert rows(read_rollup(spark, "live_ride_total", f"{folder}/out", NOW)) == [("2024-01-01", 7, 700.0, 3.5)]
