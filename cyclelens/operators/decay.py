"""Tag weights that decay, kept so that days can be added without a rescan.

A day's counts are weighted forward: one tag of day d weighs 2^((d - landmark) / half-life).
Such weights do not depend on the day they are asked for, so stored sums of days add up,
and the weight at any later day is the sum times 2^(-(day - landmark) / half-life). Weights
grow with the distance from the landmark; `rescaled` moves it long before a double is full
(after a thousand half-lives).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONGEST = 500  # half-lives between landmark and day after which a store must be rescaled


def _halvings(later: Column, earlier: Column, half_life_days: float) -> Column:
    return F.date_diff(later, earlier) / F.lit(float(half_life_days))


def _day(date: str) -> Column:
    return F.lit(date).cast("date")


def forward_weights(daily_tags: DataFrame, landmark: str, half_life_days: float) -> DataFrame:
    """(userid, tag, weight, landmark, last_day) from (userid, date, tag, cnt)."""
    date = F.col("date").cast("date")
    halvings = _halvings(date, _day(landmark), half_life_days)
    return daily_tags.groupBy("userid", "tag").agg(
        F.sum(F.col("cnt") * F.pow(F.lit(2.0), halvings)).alias("weight"),
        _day(landmark).alias("landmark"), F.max(date).alias("last_day"),
    )


def rescaled(store: DataFrame, landmark: str, half_life_days: float) -> DataFrame:
    """The same weights relative to another landmark."""
    factor = F.pow(F.lit(2.0), -_halvings(_day(landmark), F.col("landmark"), half_life_days))
    return store.withColumns({"weight": F.col("weight") * factor, "landmark": _day(landmark)})


def merged(stores: list[DataFrame], landmark: str, half_life_days: float) -> DataFrame:
    """One store of several that share no day, relative to `landmark`."""
    rows = reduce(DataFrame.unionByName, [rescaled(s, landmark, half_life_days) for s in stores])
    return rows.groupBy("userid", "tag").agg(
        F.sum("weight").alias("weight"), _day(landmark).alias("landmark"), F.max("last_day").alias("last_day")
    )


def weights_at(store: DataFrame, as_of: str, half_life_days: float) -> DataFrame:
    """(userid, tag, weight) at a day on or after the last one stored; one multiplication
    for each row."""
    late = F.col("last_day") > _day(as_of)
    far = _halvings(F.col("last_day"), F.col("landmark"), half_life_days) > LONGEST
    checked = store.where(
        F.when(late, F.raise_error(F.concat(F.lit("the store holds days after "), F.lit(as_of))).cast("boolean"))
        .when(far, F.raise_error(F.lit("the store must be rescaled")).cast("boolean"))
        .otherwise(True)
    )
    factor = F.pow(F.lit(2.0), -_halvings(_day(as_of), F.col("landmark"), half_life_days))
    return checked.select("userid", "tag", (F.col("weight") * factor).alias("weight"))
