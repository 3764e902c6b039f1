"""Bounding box, geohash and geocoder replies as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strict bounding box and the geohash alphabet.
LAT_MIN, LAT_MAX, LON_MIN, LON_MAX = 3.0, 54.0, 73.0, 136.0
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

# Form of a stored geocoder reply.
REPLY_PATTERN = r"(?s)^renderReverse&&renderReverse\((.*)\)"
DISTRICTS_PATH, FIRST_POI_TAG_PATH = "$.result.business", "$.result.pois[0].tag"

_BITS = 20  # per axis; 8 characters of 5 bits hold 40 bits
_CELLS = 1 << _BITS


def _two_characters(index: int) -> str:
    """The characters for five bits of longitude, then five of latitude, interleaved."""
    lon, lat = divmod(index, 32)
    mixed = sum((lon >> bit & 1) << 2 * bit + 1 | (lat >> bit & 1) << 2 * bit for bit in range(5))
    return GEOHASH_ALPHABET[mixed >> 5] + GEOHASH_ALPHABET[mixed & 31]


_PAIRS = ",".join(_two_characters(index) for index in range(1024))


def in_bounds(lat: Column, lon: Column) -> Column:
    """Strictly inside the box. Plain comparisons, so a filter on it reaches the scan; a
    null coordinate gives null, which a filter treats as outside."""
    return (lat > LAT_MIN) & (lat < LAT_MAX) & (lon > LON_MIN) & (lon < LON_MAX)


def _cell(value: Column, span: float) -> Column:
    """Index of the cell that holds `value`, out of 2^20 over [-span/2, span/2].

    Adding half the span can round a value just under a cell border up to the border,
    so the index steps back when the cell's own lower border lies above the value. The
    borders are exact doubles, which makes the result the one halving would give.
    """
    half, width = span / 2, span / _CELLS
    guess = F.floor((value + F.lit(half)) / F.lit(span) * F.lit(float(_CELLS)))
    guess = F.least(guess, F.lit(_CELLS - 1))
    above = guess.cast("double") * F.lit(width) - F.lit(half) > value
    return guess - above.cast("bigint")


def geohash8(lat: Column, lon: Column) -> Column:
    """Eight-character geohash; null when a coordinate is null or off the globe.

    Five bits of each axis make two characters, which one table of constants holds.
    """
    on_globe = (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    x = F.when(on_globe, _cell(lon, 360.0))
    y = F.when(on_globe, _cell(lat, 180.0))
    return F.concat(*[_characters(x, y, shift) for shift in (15, 10, 5, 0)])


def _characters(x: Column, y: Column, shift: int) -> Column:
    lon, lat = (F.shiftright(cell, shift).bitwiseAND(F.lit(31)) for cell in (x, y))
    return F.get(F.split(F.lit(_PAIRS), ","), (lon * 32 + lat).cast("int"))


def decode_reply(reply: Column) -> Column:
    """Districts named in a stored geocoder reply, or null.

    The reply wraps a JSON document in a JSONP call. `result.business` wins; if it is
    empty the tag of the first point of interest is used.
    """
    body = F.regexp_extract(reply, REPLY_PATTERN, 1)
    business = F.get_json_object(body, DISTRICTS_PATH)
    tag = F.get_json_object(body, FIRST_POI_TAG_PATH)
    return F.coalesce(F.nullif(business, F.lit("")), F.nullif(tag, F.lit("")))
