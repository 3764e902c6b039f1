"""Key lookup of a large fact table in a dictionary of unknown size.

A dictionary whose size was measured and is small is broadcast. A larger one is joined
by shuffle; adaptive execution divides the fact rows of hot keys by their measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def text_bytes(df: DataFrame) -> int:
    """Bytes of text in a table of texts and numbers, plus a fixed cost per row. One number
    reaches the driver."""
    per_row = F.lit(64)
    for name in df.columns:
        per_row = per_row + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return df.agg(F.coalesce(F.sum(per_row.cast("bigint")), F.lit(0))).first()[0]


def lookup(
    facts: DataFrame, dictionary: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """`facts` left-joined to `dictionary` (unique on `key`) by `key`.

    Pass a stored dictionary: it is read once to be measured and once to be joined. In
    the shuffle join the engine splits a key (null included) whose measured size is far
    above the others', so no list of hot keys is needed.
    """
    if text_bytes(dictionary) <= broadcast_bytes:
        return facts.join(F.broadcast(dictionary), key, "left")
    return facts.join(dictionary.hint("merge"), key, "left")
