"""Tags carried by one ride, as array-of-string columns.

Every tag of a ride weighs one. A code or distance that is null or unknown carries no
tag rather than failing the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclelens import schemas as C

_CODED = (
    ("client", C.CLIENT_TAGS),
    ("deviceType", C.DEVICE_TAGS),
    ("networkingmannerid", C.NETWORK_TAGS),
    ("unlock", C.UNLOCK_TAGS),
)


def _distance_rules(distance: Column) -> dict[str, Column]:
    return {
        C.SHORT_TRIP: distance <= 1000,
        C.MEDIUM_TRIP: (distance > 1000) & (distance < 2000),
        C.LONG_TRIP: distance >= 2000,
    }


def fixed_tag_rules() -> dict[str, Column]:
    """Tag -> condition for the closed vocabulary (everything but districts)."""
    rules = {
        tag: F.col(column) == code
        for column, tags in _CODED
        for code, tag in tags.items()
    }
    return rules | _distance_rules(F.col("distance"))


def _pick(column: str, tags: dict[int, str]) -> Column:
    chosen = None
    for code, tag in tags.items():
        hit = F.col(column) == code
        chosen = F.when(hit, tag) if chosen is None else chosen.when(hit, tag)
    return chosen


def client_tags() -> Column:
    """LN (client), LC (device) and LF (network) tags."""
    return F.array_compact(F.array(*[_pick(c, t) for c, t in _CODED[:3]]))


def ride_tags() -> Column:
    """LS (way of unlocking) and LA (distance class) tags."""
    trip = None
    for tag, hit in _distance_rules(F.col("distance")).items():
        trip = F.when(hit, tag) if trip is None else trip.when(hit, tag)
    return F.array_compact(F.array(_pick(*_CODED[3]), trip))


def district_names(districts: Column) -> Column:
    """The different entries of a comma-separated district list, an empty one included."""
    return F.array_distinct(F.split(districts, ","))


def district_tag(name: Column) -> Column:
    """BS tag of one district name."""
    return F.concat(F.lit(C.DISTRICT_PREFIX), name)


def business_tags(districts: Column) -> Column:
    """BS tags from a comma-separated district list.

    Empty entries name no district and are skipped; a district named twice counts once
    per ride. Null gives an empty array.
    """
    names = F.filter(F.split(districts, ","), lambda name: name != "")
    tagged = F.transform(F.array_distinct(names), district_tag)
    return F.coalesce(tagged, F.array().cast("array<string>"))
