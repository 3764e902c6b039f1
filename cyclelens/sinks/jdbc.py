"""JDBC sink for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "overwrite",
    connections: int = 8,
) -> None:
    """Write a report to a database table.

    The default replaces the rows and keeps the table definition, so a repeated run does
    not double them; pass `mode="append"` to add to what is there. At most `connections`
    tasks write at once. Credentials come in through `properties`."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    options = {"numPartitions": str(connections), "batchsize": "10000", "truncate": "true"}
    df.write.mode(mode).jdbc(url, table, properties=options | (properties or {}))
