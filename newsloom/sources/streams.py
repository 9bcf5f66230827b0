"""Unbounded sources. Files and Kafka can be replayed, so several queries may read the same data
and each continues from its own checkpoint; a socket can do neither and is only an option."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..fixed_values import KAFKA_TOPIC


def line_stream(spark: SparkSession, fmt: str, schema=None, path: str | None = None, **options) -> DataFrame:
    """A stream of headlines: `value` lines of text or Kafka, or the columns of a file schema."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    lines = reader.load(path) if path is not None else reader.load()
    if fmt == "kafka":
        return lines.selectExpr("cast(value as string) as value", "timestamp")
    return lines


def kafka_options(servers: str, topic: str = KAFKA_TOPIC, starting: str = "earliest") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}


def kafka_messages(
    spark: SparkSession, servers: str, topic: str = KAFKA_TOPIC, starting: str = "earliest", **options
) -> DataFrame:
    """Messages of a Kafka topic with key and value as text. Offsets are kept in the checkpoint of
    the query that writes them. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**{**kafka_options(servers, topic, starting), **options})
    return reader.load().selectExpr(
        "cast(key as string) as key", "cast(value as string) as value", "topic", "partition", "offset", "timestamp"
    )


def message_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Messages landed as text files, one JSON message per line."""
    lines = spark.readStream.format("text").options(**options).load(path)
    return lines.selectExpr("cast(null as string) as key", "value")
