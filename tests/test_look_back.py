"""Look-back trends held as state, against the trend of the whole table."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from newsloom.operators import trending_entities
from newsloom.session import state_session
from newsloom.sinks import read_replaced, replaced_table
from newsloom.streaming import live_counts, live_trending_query

START = dt.datetime(2024, 1, 1, 12)
SCHEMA = "entity_name string, entity_type string, detected_at timestamp"


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


#: What each trigger brings: repeats, rows that come late but within the look-back, and rows after it.
LANDED = [
    [("a", "T", at(0)), ("a", "T", at(0)), ("b", "T", at(1)), (None, None, at(1)), ("c", None, None)],
    [("a", "T", at(4)), ("b", "T", at(9)), ("b", "U", at(5))],
    [("b", "T", at(10.5)), ("late", "T", at(3)), ("gone", "T", at(-30))],
    [("z", "T", at(10.5)), ("a", "T", at(0.5)), (None, None, at(10))],
    [("z", "T", at(90))],
    [("gone", "T", at(2)), ("y", "T", at(80))],
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def streams(spark):
    made = state_session(spark)
    made.conf.set("spark.sql.shuffle.partitions", "2")
    return made.readStream


@pytest.fixture
def landed(spark, tmp_path):
    """Writes the rows of one trigger, later than all before."""
    folder = tmp_path / "landed"

    def write(i):
        spark.createDataFrame(LANDED[i], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
        return spark.createDataFrame([row for part in LANDED[: i + 1] for row in part], SCHEMA)

    folder.mkdir()
    return folder, write


def test_same_as_the_whole_table_after_each_trigger(spark, landed, streams, tmp_path):
    folder, write = landed
    stream = streams.schema(SCHEMA).parquet(str(folder))
    for i in range(len(LANDED)):
        whole = write(i)
        query = live_trending_query(stream, f"{tmp_path}/live", replaced_table(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", None)
        query.awaitTermination()  # each trigger is a restart from the checkpoint
        expected = trending_entities(whole, whole.agg(F.max("detected_at")).scalar())
        assert rows(read_replaced(spark, f"{tmp_path}/out")) == rows(expected), i
    live = read_replaced(spark, f"{tmp_path}/live")
    assert {r.entity_name for r in live.collect()} == {"y", "z"}  # what has left is not kept


def test_state_shrinks(spark, landed, streams, tmp_path):
    folder, write = landed
    stream = live_counts(streams.schema(SCHEMA).parquet(str(folder)))
    held = []
    for i in (0, 1, 2, 3, 4):
        write(i)
        query = (
            stream.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(availableNow=True).foreachBatch(lambda df, n: df.collect() and None).start()
        )
        query.awaitTermination()
        held.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(held[:4]) > held[4]


def test_a_repeated_batch_changes_nothing(spark, landed, streams, tmp_path):
    """The batch is done again, because its first run ended before it was committed."""
    folder, write = landed
    stream = streams.schema(SCHEMA).parquet(str(folder))
    replace, failing = replaced_table(f"{tmp_path}/out"), [True]

    def sink(df, batch_id):
        replace(df, batch_id)
        if failing:
            failing.clear()
            raise RuntimeError("lost")

    run = lambda: live_trending_query(stream, f"{tmp_path}/live", sink, f"{tmp_path}/checkpoint", None)
    whole = write(0)
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    run().awaitTermination()
    assert rows(read_replaced(spark, f"{tmp_path}/out")) == rows(trending_entities(whole, F.lit(at(1))))


def test_steps_divide_the_look_back(streams):
    stream = streams.format("rate").load().selectExpr(
        "'a' as entity_name", "'T' as entity_type", "timestamp as detected_at"
    )
    with pytest.raises(ValueError, match="multiple"):
        live_counts(stream, "10 minutes", "7 minutes")


SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from newsloom.session import session
from newsloom.sinks import read_replaced, replaced_table
from newsloom.streaming import live_trending_query

spark = session(**{
    "spark.master": "local[2]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "2",
})
spark.sql("select 'a' as entity_name, 'T' as entity_type, timestamp'2024-01-01 00:00:00' as detected_at").write.parquet("landed")
stream = spark.readStream.schema("entity_name string, entity_type string, detected_at timestamp").parquet("landed")
live_trending_query(stream, "live", replaced_table("out"), "checkpoint", None).awaitTermination()
assert read_replaced(spark, "out").first()["count"] == 1
print("fine")
"""


def test_workers_need_not_have_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=170)
    assert "fine" in done.stdout, done.stderr[-2000:]
