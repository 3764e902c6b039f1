"""Blurring of sensitive values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pseudonym(value: Column, salt: str) -> Column:
    """Salted SHA-256. Equal inputs stay equal, so the column can still be joined and
    counted; '' stays '' (an anonymous ride) and null stays null."""
    return F.when(value == "", value).otherwise(F.sha2(F.concat(F.lit(salt), value), 256))


_V4 = r"^([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\.[0-9]{1,3}(?::[0-9]+)?$"
# An IPv6 address, perhaps in brackets, with a zone or a port.
_V6 = r"^\[?(?=[^\]%]*:[^\]%]*:)([0-9A-Fa-f:.]+)(?:%[^\]]*)?(?:\](?::[0-9]+)?)?$"
_V6_LONG = r"^((?:[0-9A-Fa-f]{1,4}:){3}).*$"
_V6_SHORT = r"^((?:[0-9A-Fa-f]{1,4}:){0,2}):.*$"


def blur_ip(ip: Column) -> Column:
    """Hide the host part: the last octet of an IPv4 address, or everything after the
    third group (or the gap before it) of an IPv6 address. Ports and zones go. What is no
    address is hidden as a whole; '' stays '' and null stays null."""
    text = F.trim(ip)
    v6 = F.regexp_extract(text, _V6, 1)
    return (
        F.when(text == "", "")
        .when(text.rlike(_V4), F.regexp_replace(text, _V4, "$1.*"))
        .when(v6.rlike(_V6_LONG), F.regexp_replace(v6, _V6_LONG, "$1*"))
        .when(v6.startswith("::"), "::*")
        .when(v6.rlike(_V6_SHORT), F.regexp_replace(v6, _V6_SHORT, "$1:*"))
        .when(ip.isNotNull(), "*")
    )
