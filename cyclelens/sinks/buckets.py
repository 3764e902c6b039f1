"""Parquet tables in buckets: rows with equal keys lie in files of one number, so a join on
these keys reads them where they are.

A bucketed table is a catalogue entry. Here the entry lives as long as a call: the files
stay under their path, and whoever reads them states keys and number of buckets again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_bucketed(df: DataFrame, path: str, keys: tuple[str, ...], buckets: int) -> None:
    """`df` in `buckets` files by the hash of `keys`, sorted by them. The path must be new."""
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files are not the catalogue's


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...], buckets: int
) -> DataFrame:
    """The table that `write_bucketed` stored; joins and groupings by `keys` need no
    exchange on its side."""
    name = f"bucketed_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{place}'"
    )
    table = spark.table(name)
    table.schema  # resolved now, so it outlives the entry
    spark.sql(f"DROP TABLE {name}")
    return table
