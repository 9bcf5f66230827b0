"""Counts of the last minutes, held as state: a trigger's work goes with what came in and what expired."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

#: What tells the rows of the live counts apart.
LIVE_KEYS = ("entity_name", "entity_type")
_COUNTED = "entity_name string, entity_type string, bucket long, n long"
_CHANGED = "entity_name string, entity_type string, count long, last_seen timestamp"


def milliseconds(spark, interval: str) -> int:
    start = F.timestamp_millis(F.lit(0))
    return spark.range(1).select(F.unix_millis(start + F.expr(f"interval {interval}"))).first()[0]


def _combine():
    """Made in a function, as `_processor` is."""

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each entity and bucket of a batch, so that a frequent name is few rows in the shuffle."""
        keys = ["entity_name", "entity_type", "bucket"]
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
            yield from found.rename_columns({"count_all": "n"}).select([*keys, "n"]).to_batches()

    return combined


def _processor() -> StatefulProcessor:
    """Made in a function, so that it travels to workers that do not have this package."""

    class LookBack(StatefulProcessor):
        """Buckets of one entity: their times in milliseconds, in order, and their counts. What the
        watermark has passed is left out at once; a timer at the oldest bucket comes for entities that no
        new row touches."""

        def init(self, handle) -> None:
            self.handle = handle
            self.buckets = handle.getValueState("buckets", "times array<bigint>, counts array<bigint>")

        def stored(self) -> dict[int, int]:
            state = self.buckets.get() if self.buckets.exists() else None
            return dict(zip(state[0], state[1])) if state else {}

        def keep(self, key, found: dict[int, int], watermark: int) -> Iterator[Row]:
            live = sorted(time for time in found if time > watermark)
            if live:
                self.buckets.update((live, [found[time] for time in live]))
                self.handle.registerTimer(live[0])
            else:
                self.buckets.clear()
            yield Row(
                entity_name=key[0], entity_type=key[1], count=sum(found[time] for time in live),
                last_seen=dt.datetime.fromtimestamp(max(found) / 1000, dt.timezone.utc),
            )

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            found = self.stored()
            for row in rows:
                found[row.bucket] = found.get(row.bucket, 0) + row.n
            yield from self.keep(key, found, timerValues.getCurrentWatermarkInMs())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            found, watermark = self.stored(), timerValues.getCurrentWatermarkInMs()
            if any(time <= watermark for time in found):  # else the rows of this batch did it
                yield from self.keep(key, found, watermark)

        def close(self) -> None:
            pass

    return LookBack()


def live_counts(entities: DataFrame, lookback: str = "10 minutes", step: str = "1 seconds") -> DataFrame:
    """A stream of (entity_name, entity_type, detected_at, ...) to changes of its live counts: a row for each
    entity whose `count` over the last `lookback` changed, with the bucket it was `last_seen` in. The count is
    the whole one, so merging a repeated batch changes nothing, and 0 for an entity that has left.

    Time is that of the entities: buckets of `step`, of which `lookback` is a multiple, count from the newest
    one back. Rows that come late count while their bucket is in the look-back and are left out after it, so
    the order of arrival does not matter. Rows without a time are left out. State: at most `lookback / step`
    numbers for an entity, none for one that has left. Needs a session with RocksDB state, `state_session`.
    """
    spark = entities.sparkSession
    size, length = milliseconds(spark, step), milliseconds(spark, lookback)
    if size <= 0 or length % size:
        raise ValueError(f"{lookback} is not a multiple of {step}")
    time = F.unix_millis(F.col("detected_at").cast("timestamp"))
    rows = entities.where(F.col("detected_at").isNotNull()).select(
        F.col("entity_name").cast("string"), F.col("entity_type").cast("string"), (time - F.pmod(time, F.lit(size))).alias("bucket")
    )
    counted = rows.mapInArrow(_combine(), _COUNTED).withColumn("seen", F.timestamp_millis("bucket"))
    # a bucket is over when it is older than the look-back from the newest: one step beyond it
    late = counted.withWatermark("seen", f"{length + size} milliseconds")
    return late.groupBy(*LIVE_KEYS).transformWithState(_processor(), _CHANGED, "Update", "EventTime")
