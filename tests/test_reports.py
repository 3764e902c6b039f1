import pytest
from pyspark.sql import functions as F

from cyclelens import fixtures
from cyclelens.operators.reports import report, report_from_suite, report_suite
from cyclelens.operators.wash import wash
from cyclelens.plans.catalog import REPORTS, reports_of
from cyclelens.plans.jobs import all_reports
from tests.conftest import plan_of, rows


def test_catalogue():
    assert len(REPORTS) == 33
    assert {log: len(reports_of(log)) for log in ("unlock", "order", "recharge", "repair")} == {
        "unlock": 10, "order": 10, "recharge": 10, "repair": 3}
    assert len({s.table for s in REPORTS.values()}) == 33


@pytest.mark.parametrize("log", ["unlock", "order", "recharge", "repair"])
def test_suite_equals_single_reports(spark, sf_dir, log):
    df = fixtures.load(spark, sf_dir, log).persist()
    for spec, shared in all_reports(df, log).items():
        alone = report(df, spec)
        assert shared.columns == alone.columns
        assert rows(shared) == rows(alone), spec.name
    df.unpersist()


def test_suite_keeps_null_keys_apart_from_subtotals(spark):
    """A null dimension value is a group of its own, not a rolled-up row."""
    df = spark.createDataFrame(
        [("d", None, "c", None, 1), ("d", None, "c", 1, None), ("d", "p", None, 1, 2)],
        "date string, province string, city string, deviceType int, client int",
    ).withColumns({"unlock": F.lit(1), "networkingmannerid": F.lit(None).cast("int"),
                   "version": F.lit(None).cast("string"), "distance": F.lit(1.0),
                   "btimestamp": F.lit(0).cast("bigint")})
    specs = [s for s in reports_of("unlock") if s.additive]
    suite = report_suite(df, specs)
    for spec in specs:
        assert rows(report_from_suite(suite, specs, spec)) == rows(report(df, spec)), spec.name


@pytest.mark.parametrize("name", ["hour_peo_bike", "version_peo_bike", "unlock_area_bike"])
def test_counts_add_up_to_the_rides(rides, name):
    assert report(rides, REPORTS[name]).agg(F.sum("sum")).first()[0] == rides.count()


def test_deposits_and_top_ups_split_the_orders(spark, sf_dir):
    orders = fixtures.load(spark, sf_dir, "order")
    parts = [report(orders, REPORTS[n]) for n in ("cash_peo_order", "recharge_peo_order")]
    counted = parts[0].agg(F.sum("cashNum")).first()[0] + parts[1].agg(F.sum("rechargeNum")).first()[0]
    assert counted == orders.count()


def test_lock_log_serves_the_ride_reports_it_can(spark, sf_dir):
    locks = wash(fixtures.raw_lines(fixtures.load(spark, sf_dir, "lock")), "lock")
    rides = fixtures.load(spark, sf_dir, "unlock")
    for name in ("hour_peo_bike", "day_peo_bike", "unlock_area_bike"):
        assert rows(report(locks, REPORTS[name])) == rows(report(rides, REPORTS[name]))
    with pytest.raises(ValueError, match="distance"):
        report(locks, REPORTS["distance_area_bike"])


def test_epoch_unit(spark):
    df = spark.createDataFrame([("d", "p", "c", 1546308000000)],
                               "date string, province string, city string, timestamp long")
    assert report(df, REPORTS["hour_repair"]).first()["hour"] == "2"
    assert report(df, REPORTS["hour_repair"], epoch_unit="s").first()["hour"] == "8"


def test_only_needed_columns_and_rows_are_scanned(spark, sf_dir, tmp_path):
    fixtures.load(spark, sf_dir, "recharge").write.parquet(str(tmp_path / "log"))
    df = spark.read.parquet(str(tmp_path / "log"))
    plan = plan_of(report(df, REPORTS["cash_peo_recharge"]))
    assert "EqualTo(rechargetype,1)" in plan
    for unused in ("sessionid", "userid", "mac", "latitude", "timestamp"):
        assert unused not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    # A distinct count first shuffles by user, so no city gathers its users in one task.
    distinct = plan_of(report(df, REPORTS["day_peo_recharge"]))
    assert "userid" in distinct.split("Exchange hashpartitioning")[2]
