"""Tags that days are merged into, and weights that decay."""

import pytest

from cyclelens.operators import decay, usertags
from cyclelens.plans import jobs
from cyclelens.plans.standing import StandingTags
from cyclelens.sinks import tables
from tests.conftest import plan_of, rows

TAGS = "userid string, tag string, cnt long"


@pytest.fixture(scope="module")
def daily(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    data = [(f"u{u}", d, f"t{t}", 1 + (u * 7 + k * 3 + t) % 5) for k, d in enumerate(days)
            for u in range(40) for t in range(4) if (u + k + t) % 3]
    return spark.createDataFrame(data, "userid string, date string, tag string, cnt long").persist()


def of(daily, day):
    return daily.where(f"date = '{day}'").select("userid", "tag", "cnt")


def whole(daily):
    return rows(daily.groupBy("userid", "tag").sum("cnt"))


def test_days_in_any_order_and_twice(spark, daily, tmp_path):
    standing = StandingTags(spark, str(tmp_path / "tags"), buckets=4)
    assert rows(standing.tags()) == [] and standing.days() == []
    for day in ("2024-01-03", "2024-01-01", "2024-01-02", "2024-01-01"):
        standing.merge(day, of(daily, day))
    assert rows(standing.tags()) == whole(daily)
    assert standing.days() == ["2024-01-01", "2024-01-02", "2024-01-03"]
    standing.drop_replaced()
    assert rows(StandingTags(spark, str(tmp_path / "tags"), 4).tags()) == whole(daily)


def test_a_day_is_replaced_by_its_new_content(spark, daily, tmp_path):
    standing = StandingTags(spark, str(tmp_path), buckets=2)
    standing.merge("2024-01-01", of(daily, "2024-01-02"))
    standing.merge("2024-01-02", of(daily, "2024-01-02"))
    standing.merge("2024-01-01", of(daily, "2024-01-01"))
    assert rows(standing.tags()) == whole(daily.where("date < '2024-01-03'"))
    standing.merge("2024-01-01", spark.createDataFrame([], TAGS))
    standing.merge("2024-01-02", spark.createDataFrame([("only", "t", 2)], TAGS))
    assert rows(standing.tags()) == [("only", "t", 2)]


def test_a_failed_merge_changes_nothing(spark, daily, tmp_path, monkeypatch):
    standing = StandingTags(spark, str(tmp_path), buckets=2)
    standing.merge("2024-01-01", of(daily, "2024-01-01"))
    from cyclelens.plans import standing as module
    write = module.write_bucketed

    def failing(df, path, *rest):
        write(df, path, *rest)
        if "totals" in path:
            raise RuntimeError("lost")

    monkeypatch.setattr(module, "write_bucketed", failing)
    with pytest.raises(RuntimeError):
        standing.merge("2024-01-02", of(daily, "2024-01-02"))
    monkeypatch.setattr(module, "write_bucketed", write)
    assert standing.days() == ["2024-01-01"] and rows(standing.tags()) == rows(of(daily, "2024-01-01"))
    standing.merge("2024-01-02", of(daily, "2024-01-02"))
    assert rows(standing.tags()) == whole(daily.where("date < '2024-01-03'"))


def test_totals_are_not_shuffled(spark, daily, tmp_path):
    standing = StandingTags(spark, str(tmp_path), buckets=4)
    standing.merge("2024-01-01", of(daily, "2024-01-01"))
    totals, change = standing.documents(), of(daily, "2024-01-02").groupBy("userid").count()
    plan = plan_of(totals.hint("merge").join(change, "userid", "full"))
    side = plan.split("SortMergeJoin", 1)[1].split("totals/version=0")[0]
    assert "Exchange" not in side


def test_standing_job_reads_one_day(spark, rides, tmp_path):
    tables.write_log(rides, str(tmp_path / "log"), by_date=True)
    words = spark.createDataFrame([], "geohash8 string, business string")
    for day in ("2024-01-05", "2024-01-02", "2024-01-05"):
        jobs.standing_job(spark, str(tmp_path / "log"), words, str(tmp_path / "tags"), day)
    want = usertags.user_tags(rides.where("date in ('2024-01-02', '2024-01-05')"))
    assert rows(StandingTags(spark, str(tmp_path / "tags")).tags()) == rows(want)


def weights(df):
    return {(r.userid, r.tag): r.weight for r in df.collect()}


def close(one, two):
    return one.keys() == two.keys() and all(abs(one[k] - two[k]) <= 1e-9 * two[k] for k in two)


def test_a_day_is_added_to_yesterdays_store(spark, daily):
    want = weights(usertags.tag_decay(daily, "2024-01-09", 7))
    store = decay.forward_weights(daily.where("date < '2024-01-03'"), "2023-06-01", 7)
    today = decay.forward_weights(daily.where("date = '2024-01-03'"), "2024-01-03", 7)
    for landmark in ("2023-06-01", "2024-01-03", "2024-01-20"):
        assert close(weights(decay.weights_at(decay.merged([store, today], landmark, 7), "2024-01-09", 7)), want)


def test_moving_the_landmark_keeps_weights(spark, daily):
    store = decay.forward_weights(daily, "2019-01-01", 4)
    moved = decay.rescaled(decay.rescaled(store, "2024-01-01", 4), "2023-12-25", 4)
    assert close(weights(decay.weights_at(moved, "2024-02-01", 4)), weights(usertags.tag_decay(daily, "2024-02-01", 4)))
    with pytest.raises(Exception, match="rescaled"):
        decay.weights_at(decay.forward_weights(daily, "2004-01-01", 4), "2024-02-01", 4).collect()
    with pytest.raises(Exception, match="after 2024-01-02"):
        decay.weights_at(store, "2024-01-02", 4).collect()
