"""Raw lines on disk: compressed, in turns, for no longer than a live job needs them."""

import glob
import os
import time

import pytest

import __spark_entry__ as entry
from cyclelens.sinks.tables import write_lines
from cyclelens.sources.logs import stream_lines
from cyclelens.streaming.rollups import events, packed_upto, start_rollups
from tests.conftest import plan_of, rows
from tests.test_live import ride, send


def lines_of(spark, n, tasks):
    text = ride(city="%s").replace('"', '\\"')
    return spark.range(0, n, 1, tasks).selectExpr(f"""format_string("{text}", cast(id as string)) as value""")


def size(folder):
    return sum(os.path.getsize(f) for f in glob.glob(f"{folder}/part=*/part-*"))


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {os.path.basename(f) for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}


def gone(spark, before):
    """Whether the shuffle files made since `before` go soon; they are removed asynchronously."""
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    return not shuffle_files(spark) - before


def streamed(spark, folder, files):
    """Lines and number of batches of a stream."""
    seen, sizes = [], []

    def look(batch, number):
        seen.extend(r["value"] for r in batch.select("value").collect())
        sizes.append(len(seen))

    job = (
        stream_lines(spark, f"{folder}/in", files, kind="parquet").writeStream.foreachBatch(look)
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    assert job.awaitTermination(120)
    return seen, len(sizes)


def test_stored_lines_are_the_lines_and_small(spark, tmp_path):
    lines, folder = lines_of(spark, 4000, 3), str(tmp_path)
    write_lines(lines, f"{folder}/text", 4)
    files = write_lines(lines, f"{folder}/in", 4, kind="parquet")
    assert files == 3
    assert size(f"{folder}/in") * 4 < size(f"{folder}/text")
    seen, batches = streamed(spark, folder, files)
    assert sorted(seen) == sorted(r["value"] for r in lines.collect())
    assert batches == 4


def test_odd_lines_are_stored_as_in_text(spark, tmp_path):
    odd = spark.createDataFrame([(None,), ("",), (" {bad ",), ("{bad",), ("{bad",), ("蓝牙\t",)], "value string")
    for kind in ("text", "parquet"):
        write_lines(odd, f"{tmp_path}/{kind}", 2, kind=kind)
    as_text = rows(spark.read.text(f"{tmp_path}/text").select("value"))
    assert as_text == rows(spark.read.parquet(f"{tmp_path}/parquet").select("value"))
    assert len(as_text) == 6


def test_a_large_task_writes_files_that_many_tasks_read(spark, tmp_path):
    files = write_lines(lines_of(spark, 100_000, 1), f"{tmp_path}/in", 2, kind="parquet")
    assert files == 3
    counts = [spark.read.parquet(f).count() for f in glob.glob(f"{tmp_path}/in/part=*/part-*")]
    assert sorted(counts) == [10_000, 10_000, 20_000, 20_000, 20_000, 20_000]


def test_no_stored_lines(spark, tmp_path):
    empty = spark.createDataFrame([], "value string")
    assert write_lines(empty, f"{tmp_path}/in", 4, kind="parquet") == 1
    assert streamed(spark, str(tmp_path), 1) == ([], 0)


@pytest.mark.parametrize("kind", ["text", "parquet"])
def test_shuffles_below_the_lines_go_with_the_write(spark, tmp_path, kind):
    before = shuffle_files(spark)
    lines = lines_of(spark, 1000, 3).repartition(5, "value")
    write_lines(lines, f"{tmp_path}/in", 2, kind=kind)
    assert gone(spark, before)
    assert spark.read.format(kind).load(f"{tmp_path}/in").count() == 1000


@pytest.mark.parametrize("name, batches", [
    ("live_ride_total", 4), ("live_repair_type", 4), ("live_rejects", 4), ("live_ride_hour_state", 2)])
def test_live_queries_keep_no_lines(spark, sf_dir, tmp_path, monkeypatch, name, batches):
    sent = []

    def write(lines, path, n, kind="text"):
        sent.append((len(glob.glob(f"{tmp_path}/*/in/turn=*")), lines.count()))
        return write_lines(lines, path, n, kind)

    monkeypatch.setattr(entry, "work_folder", lambda spark, label: f"{tmp_path}/{label}")
    monkeypatch.setattr(entry.tables, "write_lines", write)
    assert not entry.queries()[name](spark, sf_dir).isEmpty()
    assert [there for there, _ in sent] == [0, 0]  # what came before has gone
    assert min(n for _, n in sent) > 0 and sum(n for _, n in sent) == 6000
    assert not glob.glob(f"{tmp_path}/*/in/turn=*")
    done = [os.path.basename(f) for d in ("checkpoint", "state") for f in glob.glob(f"{tmp_path}/*/{d}/commits/*")]
    assert sorted(done) == [str(n) for n in range(batches)]


def test_batches_and_packs_leave_no_shuffle_behind(spark, tmp_path):
    folder = str(tmp_path)
    for _ in range(3):
        send(spark, folder, ride(), ride(city="d"), "{bad")
    before = shuffle_files(spark)
    job = start_rollups(
        stream_lines(spark, f"{folder}/in", 1), "unlock", f"{folder}/out", f"{folder}/checkpoint",
        available_now=True, pack_every=2)
    assert job.awaitTermination(120)
    assert packed_upto(spark, f"{folder}/out") == 1
    assert gone(spark, before)
    kept = glob.glob(f"{folder}/out/live/batch_id=*/status=bad/*.parquet")
    assert len(kept) == 3 and all(".zstd." in f for f in kept)


def test_live_values_are_converted_in_compiled_code(spark):
    lines = spark.createDataFrame([(ride(),)], "value string").repartition(1)
    plan = plan_of(events(lines, "unlock"))
    assert plan.count("from_json(ArrayType") == 1
    parsing = [s for s in plan.split("\n") if "Generate" in s and "from_json(ArrayType" in s]
    assert len(parsing) == 1 and "try_cast" not in parsing[0]
    converting = [s.strip(" +-:") for s in plan.split("\n") if "as double)" in s]
    assert len(converting) == 1 and converting[0].startswith("Project")
