import pytest
from pyspark.sql import functions as F

from cyclelens import fixtures
from cyclelens.operators.wash import mask, parse_lines, split_valid, wash
from cyclelens.schemas import LOGS, schema_of
from tests.conftest import plan_of, rows

HERE = '"location":{"latitude":5,"longitude":80}'


@pytest.mark.parametrize("line, reason", [
    ("{bad", "malformed"),
    ("", "malformed"),
    ("   ", "malformed"),
    (None, "malformed"),
    ("[1]", "malformed"),
    ('{"client":1}', "missing_location"),
    ('{"location":null}', "missing_location"),
    ("{%s,\"client\":\"x\"}" % HERE, "bad_value:client"),
    ("{%s,\"btimestamp\":\"soon\",\"client\":\"x\"}" % HERE, "bad_value:btimestamp"),
    ('{"location":{"latitude":"north"}}', "bad_value:latitude"),
    ("{%s,\"client\":99999999999}" % HERE, "bad_value:client"),
    ("{%s,\"client\":\"2\"}" % HERE, None),
    ("{%s,\"client\":2.0}" % HERE, None),
    ("{%s,\"client\":\"\",\"distance\":null}" % HERE, None),
    ('{"location":{}}', None),
    ("  {%s}  " % HERE, None),
    ("{%s} junk" % HERE, "malformed"),
    ("{%s}{%s}" % (HERE, HERE), "malformed"),
    ("{%s},{%s}" % (HERE, HERE), "malformed"),
    ("{%s}]" % HERE, "malformed"),
    ("{%s}] }" % HERE, "malformed"),
    ("{%s,\"x\":[{\"y\":1} ]}" % HERE, None),
    ("{%s,\"distance\":\"NaN\"}" % HERE, "bad_value:distance"),
    ("{%s,\"distance\":1e999}" % HERE, "bad_value:distance"),
    ("{%s,\"btimestamp\":9223372036854775807}" % HERE, "bad_value:btimestamp"),
    ("{%s,\"etimestamp\":-99999999999999999}" % HERE, "bad_value:etimestamp"),
])
def test_reject_reasons(spark, line, reason):
    raw = spark.createDataFrame([(line, 7)], "value string, offset int")
    assert parse_lines(raw, "unlock").first()["reject_reason"] == reason
    good, rejects = split_valid(raw, "unlock")
    assert rows(rejects) == ([] if reason is None else [(line, 7, reason)])
    assert good.count() == (reason is None)


def test_values_are_coerced(spark):
    line = ('{"sessionid":5,"client":"2","deviceType":3.0,"btimestamp":"1704067200000","distance":"12.5",'
            '"unlock":"null","location":{"latitude":"5.5","longitude":80}}')
    row = wash(spark.createDataFrame([(line,)], "value string"), "unlock").first()
    assert (row.sessionid, row.client, row.deviceType, row.btimestamp, row.distance, row.unlock) == (
        "5", 2, 3, 1704067200000, 12.5, None)
    assert (row.latitude, row.longitude) == (5.5, 80.0)


@pytest.mark.parametrize("text, seconds", [
    ("1704067200000", 1704067200), ('"1704067200000"', 1704067200),
    ('"2024-01-01 00:00:01"', 1704067201), ('"2024-01-02"', 1704153600), ("null", None),
])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_lock_time_is_a_utc_timestamp(spark, text, seconds, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = spark.createDataFrame([("{%s,\"timestamp\":%s}" % (HERE, text),)], "value string")
        assert wash(raw, "lock").select(F.unix_seconds("timestamp")).first()[0] == seconds
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("log", LOGS)
def test_schema_and_round_trip(spark, sf_dir, log):
    df = fixtures.load(spark, sf_dir, log)
    washed = wash(fixtures.raw_lines(df), log)
    assert washed.schema == schema_of(log)
    if log == "lock":
        washed = washed.withColumn("timestamp", F.unix_millis("timestamp"))
    assert df.exceptAll(washed).isEmpty() and washed.exceptAll(df).isEmpty()


def test_each_line_is_parsed_once(spark):
    raw = spark.createDataFrame([("{}",)], "value string").repartition(1)
    good, rejects = split_valid(raw, "unlock")
    # The other from_json looks at lines with an early bracket only.
    assert plan_of(good).count("from_json(ArrayType") == 1
    assert plan_of(rejects).count("from_json(ArrayType") == 1


def test_values_are_converted_in_compiled_code(spark):
    raw = spark.createDataFrame([("{}",)], "value string").repartition(1)
    steps = plan_of(wash(raw, "repair")).split("\n")
    parsing = [s for s in steps if "Generate" in s and "from_json(ArrayType" in s]
    assert len(parsing) == 1 and "try_cast" not in parsing[0]
    converting = [s.strip(" +-:") for s in steps if "try_cast" in s]
    assert len(converting) == 1 and converting[0].startswith("Project")


def test_other_columns_of_any_name_stay(spark):
    raw = spark.createDataFrame([("{%s}" % HERE, 1, 2)], "value string, `_____` int, `a.b` int")
    assert parse_lines(raw, "repair").select("_____", "`a.b`").first()[:] == (1, 2)


def test_column_clash_is_refused(spark):
    raw = spark.createDataFrame([("{}", 1)], "value string, client int")
    with pytest.raises(ValueError, match="client"):
        parse_lines(raw, "lock")
    with pytest.raises(ValueError, match="unknown log"):
        schema_of("rides")


def test_masked_logs_count_the_same(spark, rides):
    from cyclelens.operators.reports import report
    from cyclelens.plans.catalog import REPORTS

    spec = REPORTS["day_peo_bike"]
    assert rows(report(mask(rides, "s"), spec)) == rows(report(rides, spec))
    blank = mask(rides, "s").where("userid = ''").count()
    assert blank == rides.where("userid = ''").count() > 0
    one_column = mask(rides, "s", ("ip",))
    assert one_column.columns == rides.columns
    assert one_column.select("userid").exceptAll(rides.select("userid")).isEmpty()


def test_extreme_lock_time_is_a_reject(spark):
    raw = spark.createDataFrame([("{%s,\"timestamp\":9223372036854775807}" % HERE,)], "value string")
    assert parse_lines(raw, "lock").first()["reject_reason"] == "bad_value:timestamp"
