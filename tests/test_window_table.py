"""The windowed sink: merging, work in proportion to the change, expiry."""

import datetime as dt
import glob
import os

import pytest

from newsloom.sinks import WindowTable, merged_table, read_replaced

DAY = dt.datetime(2024, 1, 31, 12)
SCHEMA = "topic string, time_window timestamp, n long"


def at(days, minutes=0):
    return DAY + dt.timedelta(days=days, minutes=minutes)


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}


def rows(df):
    return sorted(map(tuple, df.select("topic", "time_window", "n").collect()), key=repr)


def test_same_rows_as_a_table_written_anew(spark, tmp_path):
    batches = [
        [("a", at(0), 1), ("b", at(0), 1), (None, at(0), 4)],
        [("a", at(0), 2), ("a", at(1), 1), ("a", at(1, 1), 7)],
        [(None, at(0), 5), ("b", at(1), 3)],
        [],
    ]
    table, whole = WindowTable(f"{tmp_path}/w", ("topic", "time_window")), merged_table(f"{tmp_path}/m", ("topic", "time_window"))
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA)
        table(df, i)
        table(df, i)  # a repeated batch
        whole(df.where("topic is not null"), i)
    found = rows(table.read(spark))
    assert [r for r in found if r[0]] == rows(read_replaced(spark, f"{tmp_path}/m"))
    assert [r for r in found if not r[0]] == [(None, at(0), 5)]
    assert rows(table.read(spark, at(1))) == [("a", at(1), 1), ("a", at(1, 1), 7), ("b", at(1), 3)]


def test_only_touched_folders_are_written(spark, tmp_path):
    table = WindowTable(f"{tmp_path}/w", ("topic", "time_window"))
    table(spark.createDataFrame([("a", at(d), 1) for d in range(12)], SCHEMA), 0)
    for day in range(12, 15):
        before = files(f"{tmp_path}/w")
        table(spark.createDataFrame([("a", at(day), 1), ("a", at(day - 1), 2)], SCHEMA), day)
        after = files(f"{tmp_path}/w")
        assert len({os.path.dirname(f) for f in after if before.get(f) != after[f]}) == 2
    assert table.read(spark).count() == 15


def test_old_windows_expire_as_folders(spark, tmp_path):
    table = WindowTable(f"{tmp_path}/w", ("topic", "time_window"), keep=dt.timedelta(hours=2), unit="hour")
    for i in range(6):
        table(spark.createDataFrame([("a", at(0, 60 * i), i)], SCHEMA), i)
    assert [r[2] for r in rows(table.read(spark))] == [3, 4, 5]
    assert len(os.listdir(f"{tmp_path}/w")) <= 3 + 2  # and the marks of a write


def test_before_the_first_batch(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert WindowTable(f"{tmp_path}/w", ("topic",), schema).read(spark).collect() == []
    with pytest.raises(FileNotFoundError):
        WindowTable(f"{tmp_path}/w", ("topic",)).read(spark)
