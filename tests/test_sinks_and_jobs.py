import os

import pytest
from pyspark.sql import functions as F

import cyclelens.session as settings
from cyclelens import fixtures
from cyclelens.operators import geodict, usertags
from cyclelens.operators.reports import report
from cyclelens.operators.wash import mask
from cyclelens.plans import jobs
from cyclelens.plans.catalog import REPORTS, reports_of
from cyclelens.schemas import schema_of
from cyclelens.sinks import tables
from cyclelens.sinks.jdbc import write_jdbc
from cyclelens.sources.logs import read_lines, read_log
from tests.conftest import plan_of, rows


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("codec", ["snappy", "gzip"])
def test_log_codec_and_mode(spark, rides, tmp_path, codec):
    path = str(tmp_path / "log")
    tables.write_log(rides, path, codec)
    assert all(codec_name(f) == codec for f in os.listdir(path) if f.endswith(".parquet"))
    same(read_log(spark, path, "unlock"), rides)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        tables.write_log(rides, path, codec)


def codec_name(file):
    return {"snappy": "snappy", "gz": "gzip"}[file.split(".")[-2]]


def test_log_by_date_keeps_types_and_prunes(spark, rides, tmp_path):
    path = str(tmp_path / "log")
    tables.write_log(rides, path, by_date=True)
    df = read_log(spark, path, "unlock")
    assert df.schema == schema_of("unlock")
    same(df, rides)
    plan = plan_of(df.where("date = '2024-01-03'").select("userid"))
    assert "PartitionFilters: [isnotnull(date" in plan


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_wash_job(spark, rides, tmp_path, compression):
    lines = fixtures.damaged_lines(rides).select("value")
    lines.write.option("compression", compression).text(str(tmp_path / "raw"))
    jobs.wash_job(spark, "unlock", str(tmp_path / "raw"), str(tmp_path / "washed"), salt="s")
    good = read_log(spark, str(tmp_path / "washed/status=good"), "unlock")
    rejected = spark.read.parquet(str(tmp_path / "washed/status=rejected"))
    assert good.count() + rejected.count() == rides.count()
    assert rejected.where("reject_reason is null or value is null").isEmpty()
    kind = F.expr("btimestamp div 1000 % 22")
    same(good, mask(rides.where(~kind.isin(0, 1, 2, 3, 5, 6, 7, 8, 9, 10)), "s"))
    assert read_lines(spark, str(tmp_path / "raw")).columns == ["value"]


def test_report_sink_replaces_only_its_dates(spark, rides, tmp_path):
    path = str(tmp_path / "report")
    spec = REPORTS["hour_peo_bike"]
    whole = report(rides, spec)
    tables.write_report(whole, path)
    tables.write_report(whole, path)
    day = whole.where("date = '2024-01-03'").withColumn("sum", F.col("sum") + 1)
    tables.write_report(day, path)
    stored = spark.read.schema(whole.schema).parquet(path).select(*whole.columns)
    same(stored, whole.withColumn("sum", F.col("sum") + (F.col("date") == "2024-01-03").cast("long")))


def test_report_job_hands_over_every_report(spark, sf_dir, tmp_path):
    df = fixtures.load(spark, sf_dir, "recharge")
    tables.write_log(df, str(tmp_path / "log"))
    seen = {}
    jobs.report_job(spark, "recharge", str(tmp_path / "log"),
                    lambda out, spec: seen.update({spec.table: rows(out)}))
    assert seen == {s.table: rows(report(df, s)) for s in reports_of("recharge")}


def test_tag_jobs(spark, rides, sf_dir, tmp_path):
    log, words = str(tmp_path / "log"), str(tmp_path / "dictionary")
    tables.write_log(rides, log)
    replies = fixtures.load(spark, sf_dir, "replies")
    jobs.dictionary_job(spark, "unlock", log, replies, words)
    dictionary = spark.read.parquet(words)
    same(dictionary, geodict.geo_dictionary(geodict.distinct_points(rides), replies))

    for day in ("2024-01-03", "2024-01-04", "2024-01-03"):
        jobs.detail_job(spark, log, dictionary, str(tmp_path / "detail"), day)
    daily = usertags.user_tags(rides, dictionary, ("userid", "date"))
    want = usertags.tag_detail(daily).where("day in ('2024-01-03', '2024-01-04')")
    stored = spark.read.schema(want.schema).parquet(str(tmp_path / "detail"))
    same(stored.select(*want.columns), want)

    jobs.tag_search_job(spark, log, dictionary, str(tmp_path / "search"), 5)
    index = spark.read.parquet(str(tmp_path / "search/index"))
    same(index, usertags.user_tags(rides, dictionary))
    assert "EqualTo(tag,LNiphone)" in plan_of(index.where("tag = 'LNiphone'"))
    documents = spark.read.parquet(str(tmp_path / "search/documents"))
    assert documents.count() == index.select("userid").distinct().count()


class Recorder:
    """Stands in for the writer of a DataFrame."""

    def __init__(self):
        self.calls = {}

    @property
    def write(self):
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def jdbc(self, url, table, properties):
        self.calls |= {"url": url, "table": table, "properties": properties}


def test_jdbc_arguments():
    df = Recorder()
    write_jdbc(df, "jdbc:x:y", "dayPeoBike", {"user": "u", "batchsize": "5"})
    assert df.calls == {
        "mode": "overwrite", "url": "jdbc:x:y", "table": "dayPeoBike",
        "properties": {"numPartitions": "8", "batchsize": "5", "truncate": "true", "user": "u"}}
    write_jdbc(df, "jdbc:x:y", "t", mode="append")
    assert df.calls["mode"] == "append"
    with pytest.raises(ValueError):
        write_jdbc(df, "jdbc:x:y", "t", mode="ignore")


def test_work_folder_needs_a_shared_root_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        Context.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            settings.work_folder(Session(), "x")
    assert settings.work_folder(spark, "x") != settings.work_folder(spark, "x")


def test_scratch_removes_what_was_written(spark):
    with settings.scratch(spark):
        folder = settings.work_folder(spark, "x")
        spark.range(3).write.parquet(folder)
        assert os.path.exists(folder)
    assert not os.path.exists(folder)
    kept = settings.written(spark.range(3), "y")
    assert kept.count() == 3


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_overwrite_leaves_nothing_behind(spark, rides, tmp_path, mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        path, log = str(tmp_path / "washed"), str(tmp_path / "log")
        lines = fixtures.damaged_lines(rides).select("value")
        tables.write_washed(lines, "unlock", path)
        tables.write_washed(fixtures.raw_lines(rides), "unlock", path, mode="overwrite")
        assert spark.read.parquet(path).where("status = 'rejected'").isEmpty()
        tables.write_log(rides, log, by_date=True)
        one_day = rides.where("date = '2024-01-03'")
        tables.write_log(one_day, log, mode="overwrite", by_date=True)
        same(read_log(spark, log, "unlock"), one_day)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_rejects_keep_their_origin(spark, tmp_path):
    raw = spark.createDataFrame([("{bad", 7, "f")], "value string, offset long, file string")
    tables.write_washed(raw, "unlock", str(tmp_path / "w"))
    got = spark.read.parquet(str(tmp_path / "w")).select("value", "offset", "file", "reject_reason").first()
    assert tuple(got) == ("{bad", 7, "f", "malformed")


def test_completion_job(spark, rides, sf_dir, tmp_path):
    log, target = str(tmp_path / "log"), str(tmp_path / "dictionary")
    tables.write_log(rides, log)
    replies = fixtures.load(spark, sf_dir, "replies")
    whole = geodict.geo_dictionary(geodict.distinct_points(rides), replies)
    known = whole.where("geohash8 < 'w'").withColumn("business", F.concat(F.lit("old-"), "business"))
    jobs.completion_job(spark, "unlock", log, known, replies, target)
    same(spark.read.parquet(target), known.unionByName(whole.where("geohash8 >= 'w'")))
