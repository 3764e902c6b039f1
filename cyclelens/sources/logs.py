"""Raw text logs and washed Parquet logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cyclelens.schemas import schema_of


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines (column `value`) of plain or compressed text files.

    A gzip file cannot be split and is read by one task; deliver many files, or a
    splittable codec such as bzip2."""
    return spark.read.text(path)


def read_log(spark: SparkSession, path: str, log: str) -> DataFrame:
    """A washed log, with the declared schema and column order.

    The schema is passed in, so a table partitioned by `date` keeps it a string."""
    schema = schema_of(log)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None, kind: str = "text") -> DataFrame:
    """A stream of raw lines from files that arrive in a folder, `kind` being how `write_lines`
    stored them."""
    reader = spark.readStream.format(kind)
    if kind == "parquet":
        reader = reader.schema("value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
