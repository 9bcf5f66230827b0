"""JSON messages to article lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..streaming import message_query


def run_messages(messages: DataFrame, path: str, checkpoints: str, now: bool = False) -> StreamingQuery:
    every = {"every": None} if now else {}
    return message_query(messages, path, f"{checkpoints}/lines", **every)
