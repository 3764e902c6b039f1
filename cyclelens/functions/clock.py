"""Hours, dates and durations from epoch numbers, always in UTC.

The arithmetic stays on integers, so the answer does not depend on the session time
zone and needs no formatter per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TICKS_PER_HOUR = {"ms": 3_600_000, "s": 3_600}


def _ticks(unit: str) -> int:
    if unit not in _TICKS_PER_HOUR:
        raise ValueError(f"epoch unit must be 'ms' or 's', not {unit!r}")
    return _TICKS_PER_HOUR[unit]


def utc_hour(epoch: Column, unit: str = "ms") -> Column:
    """Hour of day as an unpadded string: '0' … '23'."""
    hour = _ticks(unit)
    in_day = F.pmod(epoch, F.lit(24 * hour))
    return F.call_function("div", in_day, F.lit(hour)).cast("string")


def utc_date(epoch: Column, unit: str = "ms") -> Column:
    """Calendar date as 'yyyy-MM-dd'; null for an epoch beyond any calendar."""
    day = 24 * _ticks(unit)
    days = F.call_function("div", F.try_subtract(epoch, F.pmod(epoch, F.lit(day))), F.lit(day))
    return F.date_from_unix_date(days.try_cast("int")).cast("string")


def ride_hours(begin: Column, end: Column) -> Column:
    """Length of a ride in hours, from epoch milliseconds."""
    return (end - begin).cast("double") / F.lit(3_600_000.0)
