"""Messages to Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..fixed_values import KAFKA_TOPIC


def publish(df: DataFrame, servers: str, topic: str = KAFKA_TOPIC, **options) -> None:
    """Write (key, value) rows to a topic. Needs Spark's Kafka connector on the class path."""
    (
        df.select("key", "value")
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, **options})
        .save()
    )
