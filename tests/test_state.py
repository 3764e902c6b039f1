"""Running totals in the state store."""

import os
import time
from datetime import datetime, timedelta, timezone

import pytest

from cyclelens.sources.logs import stream_lines
from cyclelens.streaming import state
from tests.conftest import rows
from tests.test_live import ride, send


@pytest.fixture(autouse=True)
def settings(spark):
    before = {k: spark.conf.get(k, None) for k in state.state_settings()}
    for key, value in state.state_settings().items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run(spark, folder, name="live_ride_area", **how):
    job = state.start_state_rollup(
        stream_lines(spark, f"{folder}/in", 1), name, f"{folder}/state", available_now=True, **how)
    assert job.awaitTermination(120)


def totals(spark, folder, as_of=None, name="live_ride_area"):
    return rows(state.read_state_rollup(spark, name, f"{folder}/state", as_of))


def test_totals_restart_and_replay(spark, tmp_path):
    folder = str(tmp_path)
    send(spark, folder, ride(), ride(distance=50.5), ride(city="d"), "{bad", '{"btimestamp":"soon"}')
    run(spark, folder)
    send(spark, folder, ride(minutes=15, distance="null"))
    run(spark, folder)
    want = [("2024-01-01", "p", "c", 3, 150.5, 1.25), ("2024-01-01", "p", "d", 1, 100.0, 0.5)]
    assert totals(spark, folder) == want
    run(spark, folder)  # a restart without new lines
    assert totals(spark, folder) == want
    # Without its commit record the last batch runs again, from the state before it.
    last = max(int(n) for n in os.listdir(f"{folder}/state/commits") if n.isdigit())
    for record in (f"{last}", f".{last}.crc"):
        os.remove(f"{folder}/state/commits/{record}")
    run(spark, folder)
    assert totals(spark, folder) == want


def test_keys_run_out_after_two_days(spark, tmp_path):
    folder = str(tmp_path)
    send(spark, folder, ride())
    before = datetime.now(timezone.utc)
    run(spark, folder)
    after = datetime.now(timezone.utc)
    limit = timedelta(seconds=172_800)
    assert len(totals(spark, folder, before + limit - timedelta(seconds=1))) == 1
    assert totals(spark, folder, after + limit) == []


def test_idle_keys_start_anew(spark, tmp_path):
    folder = str(tmp_path)
    send(spark, folder, ride(city="a"), ride(city="b", distance="null"))
    run(spark, folder, idle_seconds=2)
    time.sleep(2.5)
    assert totals(spark, folder) == []
    send(spark, folder, ride(city="a"))
    run(spark, folder, idle_seconds=2)
    later = datetime.now(timezone.utc) - timedelta(seconds=60)
    assert ("2024-01-01", "p", "a", 1, 100.0, 0.5) in totals(spark, folder, later)
    assert not any(r[2] == "a" and r[3] != 1 for r in totals(spark, folder, later))
