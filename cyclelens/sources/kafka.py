"""Kafka source. Needs the spark-sql-kafka package on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# One topic per live log.
TOPICS = {"unlock": "bike_unlock", "order": "bike_order",
          "recharge": "bike_recharge", "repair": "bike_repair"}


def kafka_options(servers: str, log: str, max_per_batch: int | None = None) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": TOPICS[log],
        "startingOffsets": "earliest",
    }
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def kafka_lines(
    spark: SparkSession, servers: str, log: str, max_per_batch: int | None = None
) -> DataFrame:
    """The log's topic as a stream of raw lines (column `value`).

    Offsets are kept in the checkpoint of the query that reads the stream. On the first
    run after a long stop, `max_per_batch` keeps a batch from swallowing the backlog."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, log, max_per_batch))
    return stream.load().selectExpr("cast(value as string) as value")
