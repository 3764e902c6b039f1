"""Text to typed values, in the lenient way the JSON logs need.

A quoted number is still a number. Text that cannot be read becomes null here and is
reported by `unreadable`, so that washing can set the line aside.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for "no value".
_BLANKS = ("", "null", "NULL")

# Epoch milliseconds that are dates of four-digit years.
EPOCH_MIN, EPOCH_MAX = -62_135_596_800_000, 253_402_300_799_999


def to_type(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.DoubleType):
        return _finite(text)
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        whole = text.try_cast(dtype)
        return F.coalesce(whole, _finite(text).try_cast(dtype))
    if isinstance(dtype, T.TimestampType):
        millis = F.timestamp_millis(to_epoch(text))
        with_time = F.concat(text, F.lit("Z")).try_cast("timestamp")
        date_only = F.concat(text, F.lit(" 00:00:00Z")).try_cast("timestamp")
        return F.coalesce(millis, with_time, date_only)
    raise TypeError(f"no coercion to {dtype.simpleString()}")


def _finite(text: Column) -> Column:
    """A double; NaN and infinities are no numbers here, they would spoil every sum.

    Blanks are kept from the cast, which throws and catches an exception for each."""
    number = F.when(~text.isin(*_BLANKS), text).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_epoch(text: Column) -> Column:
    """Epoch milliseconds within the years 1 to 9999, which no later step overflows on."""
    millis = to_type(text, T.LongType())
    return F.when(millis.between(EPOCH_MIN, EPOCH_MAX), millis)


def unreadable(text: Column, typed: Column) -> Column:
    """True where a value was given but could not be read."""
    return typed.isNull() & text.isNotNull() & ~text.isin(*_BLANKS)
