"""Sinks that see one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from .files import Sink


def fan_out(sinks: Sequence[Sink], keep: bool = False) -> Callable[[DataFrame, int], None]:
    """Hand each micro-batch that is not empty to all sinks in order.

    With several sinks, or with `keep` for a batch that is costly to make, the batch is kept, so
    its work is not run again for each. An error in a sink fails the query: the batch is not
    committed and is repeated on restart.
    """

    def handle(df: DataFrame, batch_id: int) -> None:
        shared = keep or len(sinks) > 1
        if shared:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not df.isEmpty():
                for sink in sinks:
                    sink(df, batch_id)
        finally:
            if shared:
                df.unpersist()

    return handle


def _writer(df: DataFrame, checkpoint: str, mode: str, every: str | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def start(
    df: DataFrame, sinks: Sequence[Sink] | Sink, checkpoint: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Start a query into `sinks`, with a trigger interval like `"3 seconds"`, or over what is
    available now and then stop. The checkpoint is required: without it a restart loses its place."""
    listed = [sinks] if callable(sinks) else list(sinks)
    return _writer(df, checkpoint, mode, every).foreachBatch(fan_out(listed, mode != "append")).start()


def start_lines(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a `line` column to a text folder with Spark's exactly-once file sink. Each batch's
    progress holds the number of lines as the observed metric `written.lines`."""
    counted = df.select("line").observe("written", F.count(F.lit(1)).alias("lines"))
    return _writer(counted, checkpoint, "append", every).format("text").start(path)


def wait(queries: Sequence[StreamingQuery]) -> None:
    """Wait until all queries have ended. When one fails the others are stopped and its error is
    raised, whichever it is."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(1)
    finally:
        for query in queries:
            query.stop()
    for query in queries:
        query.awaitTermination()
