"""Files and previews."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

Sink = Callable[[DataFrame, int], None]
BATCH = "batch_id"
_DAY, _HOUR, _VERSION = "day", "hour", "v"
_FOLDER, _MOMENT = "windows_of", "'t'yyyyMMddHHmm"  # no name that reads as a date or a number


def write_lines(df: DataFrame, path: str, line_col: str = "line") -> int:
    """Append lines to a text folder, creating it if absent, and return how many. The write
    commits or raises; the lines are counted on their way."""
    written = Observation()
    counted = df.select(line_col).observe(written, F.count(F.lit(1)).alias("lines"))
    counted.write.mode("append").text(path)
    return written.get["lines"]


def preview(df: DataFrame, n: int = 20) -> None:
    df.show(n, truncate=False)


def top(df: DataFrame, n: int) -> list[Row]:
    """The first n rows on the driver."""
    return df.limit(n).collect()


def batch_table(path: str) -> Sink:
    """Append micro-batches to a parquet folder. Each batch has a folder of its own that a repeated
    batch replaces, so a restart adds no row twice."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All rows a `batch_table` sink wrote; with a schema, an empty table before its first batch."""
    if schema is not None and not _folders(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).drop(BATCH)


class HourlyTable:
    """A table of timed rows in folders of day, hour and micro-batch, for readers that look back over
    some hours. As a sink it replaces a repeated batch's folders; `read` prunes by day and hour."""

    def __init__(self, path: str, ts_col: str, schema, hours: int = 1):
        """`hours`: how many hours of a day share a folder."""
        self.path, self.ts_col, self.schema, self.hours = path, ts_col, schema, hours

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        moments = {_DAY: F.date_format(self.ts_col, "yyyy-MM-dd"), _HOUR: self._hour(F.hour(self.ts_col)), BATCH: F.lit(batch_id)}
        writer = df.withColumns(moments).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(_DAY, _HOUR, BATCH).parquet(self.path)

    def _hour(self, hour):
        return hour - hour % self.hours

    def read(self, spark: SparkSession, since: dt.datetime | None = None) -> DataFrame:
        """The rows of `since` (in the session's time zone) and later; no rows before the first batch."""
        if not _folders(spark, self.path):
            return spark.createDataFrame([], self.schema)
        rows = spark.read.option("basePath", self.path).parquet(self.path)
        if since is not None:
            day = since.strftime("%Y-%m-%d")
            later = (F.col(_DAY) > F.lit(day).cast(rows.schema[_DAY].dataType)) | (
                (F.col(_DAY) == F.lit(day).cast(rows.schema[_DAY].dataType)) & (F.col(_HOUR) >= self._hour(since.hour))
            )
            rows = rows.where(later & (F.col(self.ts_col) >= F.lit(since)))
        return rows.drop(_DAY, _HOUR, BATCH)

    def compact(self, spark: SparkSession, day: str, hour: int) -> None:
        """Join an old hour's folders into one. For hours that no query looks back to any more: until
        the old folders are gone, a reader of this hour sees rows twice."""
        folder = f"{self.path}/{_DAY}={day}/{_HOUR}={hour}"
        old = _folders(spark, folder)
        if len(old) < 2:
            return
        rows = spark.read.option("basePath", folder).parquet(folder).drop(BATCH)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/_joined")
        system, _ = _file_system(spark, folder)
        system.rename(_path(spark, f"{folder}/_joined"), _path(spark, f"{folder}/{BATCH}=-{time.time_ns()}"))
        for name in old:
            system.delete(_path(spark, f"{folder}/{name}"), True)


def replaced_table(path: str, versions: int = 2) -> Sink:
    """Keep the newest result, for complete results and trends. Each result is a folder of its own
    and becomes visible to `read_replaced` as a whole, when it is complete; the `versions` last ones
    stay, for readers that have begun."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df.write.parquet(f"{path}/{_VERSION}{time.time_ns():020d}")
        system, _ = _file_system(spark, path)
        for name in _complete(spark, path)[:-versions]:
            system.delete(_path(spark, f"{path}/{name}"), True)

    return write


def read_replaced(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The newest complete result of a `replaced_table` or `merged_table`; with a schema, an empty
    table before the first."""
    complete = _complete(spark, path)
    if not complete and schema is not None:
        return spark.createDataFrame([], schema)
    if not complete:
        raise FileNotFoundError(f"no complete result in {path}")
    return spark.read.parquet(f"{path}/{complete[-1]}")


def merged_table(path: str, keys: Sequence[str], keep: Column | None = None, versions: int = 2) -> Sink:
    """Merge changed rows into the newest result by their keys, for queries in update mode. `keep` is
    a condition on rows, such as a time to live, that bounds the table: it is written anew each time.
    For results that grow, `WindowTable` writes only what changed."""
    replace = replaced_table(path, versions)

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        before = read_replaced(spark, path, df.schema)
        new = df.select(*[F.col(key).alias(f"_{key}") for key in keys])
        same = reduce(and_, [before[key].eqNullSafe(new[f"_{key}"]) for key in keys])
        merged = before.join(new, same, "left_anti").select(*df.columns).unionByName(df)
        replace(merged if keep is None else merged.where(keep), batch_id)

    return write


class WindowTable:
    """A table of windowed results for queries in update mode, in a folder for each day (or another `unit`
    of time) of the windows. As a sink it merges changed rows into the folders they belong to and writes
    no other, so that a trigger's work grows with the change and not with the history. With `keep`, folders
    whose windows all began longer than that before the newest window are dropped."""

    def __init__(
        self, path: str, keys: Sequence[str], schema=None, window_col: str = "time_window",
        keep: dt.timedelta | None = None, unit: str = "day",
    ):
        """`schema`, a StructType, is only needed to read the table before its first batch."""
        self.path, self.keys, self.schema, self.window_col, self.keep, self.unit = path, list(keys), schema, window_col, keep, unit

    def _folder(self, moment) -> Column:
        return F.date_format(F.date_trunc(self.unit, moment), _MOMENT)

    def _stored(self, spark: SparkSession, schema=None) -> DataFrame:
        schema = self.schema or schema
        there = bool(_folders(spark, self.path))
        if schema is None:
            if not there:
                raise FileNotFoundError(f"no rows in {self.path} yet")
            return spark.read.parquet(self.path)
        schema = StructType([*schema, StructField(_FOLDER, StringType())])
        return spark.read.schema(schema).parquet(self.path) if there else spark.createDataFrame([], schema)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        """A repeated batch merges the same rows again, which changes nothing."""
        spark = df.sparkSession
        changed = df.withColumn(_FOLDER, self._folder(F.col(self.window_col))).persist()
        try:
            found = changed.groupBy(_FOLDER).agg(F.max(self.window_col).alias("newest")).collect()  # a row for each folder
            touched = [row[_FOLDER] for row in found]
            before = self._stored(spark, df.schema).where(F.col(_FOLDER).isin(touched))
            same = None
            new = changed.select(_FOLDER, *[F.col(key).alias(f"_{key}") for key in self.keys]).withColumnRenamed(_FOLDER, "_new")
            for old, other in [(_FOLDER, "_new"), *((key, f"_{key}") for key in self.keys)]:
                one = before[old].eqNullSafe(new[other])
                same = one if same is None else same & one
            merged = before.join(new, same, "left_anti").unionByName(changed).hint("rebalance", _FOLDER)
            writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(_FOLDER).parquet(self.path)
        finally:
            changed.unpersist()
        if self.keep is not None and found:
            self._drop(spark, max(row["newest"] for row in found if row["newest"]) - self.keep)

    def _drop(self, spark: SparkSession, since: dt.datetime) -> None:
        oldest = spark.range(1).select(self._folder(F.lit(since))).first()[0]
        system, _ = _file_system(spark, self.path)
        for name in _folders(spark, self.path):
            if name.partition("=")[2] < oldest:  # names are in order of time
                system.delete(_path(spark, f"{self.path}/{name}"), True)

    def read(self, spark: SparkSession, since: dt.datetime | None = None) -> DataFrame:
        """The rows of windows that began at `since` or later; no rows before the first batch."""
        rows = self._stored(spark)
        if since is not None:
            rows = rows.where((F.col(_FOLDER) >= self._folder(F.lit(since))) & (F.col(self.window_col) >= F.lit(since)))
        return rows.drop(_FOLDER)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    place = _path(spark, path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the data folders in a folder, in order; none if it is absent."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    names = [status.getPath().getName() for status in system.listStatus(place) if status.isDirectory()]
    return sorted(name for name in names if name[0] not in "._")


def _complete(spark: SparkSession, path: str) -> list[str]:
    """The result folders whose write has ended, the newest last."""
    system, _ = _file_system(spark, path)
    names = [name for name in _folders(spark, path) if name.startswith(_VERSION)]
    return [name for name in names if system.exists(_path(spark, f"{path}/{name}/_SUCCESS"))]
