import datetime as dt
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from newsloom.operators import enrich_articles, extract_entities, topic_trends, trending_entities, word_cloud
from newsloom.plans import run_entities, run_messages, run_topics
from newsloom.sinks import (
    HourlyTable, batch_table, fan_out, merged_table, read_batches, read_replaced, replaced_table, start, wait,
)
from newsloom.sources import line_stream, message_stream
from newsloom.streaming import CLOUD_KEYS, TREND_KEYS, topic_query, word_cloud_query

HEADLINES = [
    ["Intelligence artificielle au tennis", "Emmanuel Macron visite Paris"],
    ["La bourse de Paris", "Le climat change", "Une voiture rouge"],
    ["Emmanuel Macron parle", "Le sport à Paris"],
]
AS_OF = dt.datetime(2024, 1, 1, 12)


@pytest.fixture
def headlines(tmp_path):
    folder = tmp_path / "headlines"
    folder.mkdir()
    for i, lines in enumerate(HEADLINES):
        (folder / f"{i}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(folder)


def stream(spark, path):
    return line_stream(spark, "text", path=path, maxFilesPerTrigger=1)


def rows(df, *without):
    return sorted((tuple(r) for r in df.drop(*without).collect()), key=repr)


def test_topic_job_equals_batch(spark, headlines, tmp_path):
    out = tmp_path / "out"
    sinks = {
        "streaming_articles": batch_table(f"{out}/articles"),
        "trending_topics": merged_table(f"{out}/topics", TREND_KEYS),
        "wordcloud_realtime": merged_table(f"{out}/words", CLOUD_KEYS),
    }

    def run():
        wait(run_topics(stream(spark, headlines), sinks, f"{tmp_path}/checkpoints", now=True, ts=F.lit(AS_OF)))

    run()
    batch = enrich_articles(spark.read.text(headlines), ts=F.lit(AS_OF))
    assert rows(read_batches(spark, f"{out}/articles")) == rows(batch)
    assert len(list((out / "articles").iterdir())) == 3
    assert rows(read_replaced(spark, f"{out}/topics")) == rows(topic_trends(batch, "topic", "received_date"))
    cloud = word_cloud(batch, "title", "topic")
    assert rows(read_replaced(spark, f"{out}/words"), "expires_at", "time_window") == rows(cloud, "expires_at")
    assert len(list((out / "words").iterdir())) == 2  # the last two results

    run()  # a restart finds nothing new
    assert rows(read_batches(spark, f"{out}/articles")) == rows(batch)


def test_new_lines_after_a_restart(spark, headlines, tmp_path):
    counts = merged_table(f"{tmp_path}/topics", TREND_KEYS)

    def run():
        articles = enrich_articles(stream(spark, headlines), ts=F.lit(AS_OF))
        topic_query(articles, counts, f"{tmp_path}/checkpoint", None).awaitTermination()
        return {r.topic: r["count"] for r in read_replaced(spark, f"{tmp_path}/topics").collect()}

    before = run()
    with open(f"{headlines}/new.txt", "w", encoding="utf-8") as f:
        f.write("Encore du sport\n")
    after = run()
    assert after["sport"] == before["sport"] + 1
    assert {k: v for k, v in after.items() if k != "sport"} == {k: v for k, v in before.items() if k != "sport"}


def test_entity_job_equals_batch(spark, headlines, tmp_path):
    places = spark.createDataFrame([("Paris", "LOC"), ("Emmanuel Macron", "PER")], "phrase string, entity_type string")
    sinks = {
        "streaming_articles": batch_table(f"{tmp_path}/articles"),
        "extracted_entities": batch_table(f"{tmp_path}/entities"),
        "trending_entities": replaced_table(f"{tmp_path}/trending"),
    }
    recent = lambda: read_batches(spark, f"{tmp_path}/entities")
    wait(run_entities(stream(spark, headlines), sinks, recent, f"{tmp_path}/checkpoints", places, now=True))
    expected = extract_entities(spark.read.text(headlines), "value", places)
    assert rows(recent(), "detected_at") == rows(expected, "detected_at")
    assert read_batches(spark, f"{tmp_path}/articles").count() == 7
    trending = read_replaced(spark, f"{tmp_path}/trending")
    assert {r.entity_name: r["count"] for r in trending.collect()}["Paris"] == 3
    assert rows(trending, "time_window") == rows(trending_entities(recent()), "time_window")


def test_message_job(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    for i in range(3):
        articles = [{"title": f"t{i}", "publishedAt": "2024"}, {"title": None}]
        (landed / f"{i}.json").write_text(json.dumps({"articles": articles}) + "\n{bad\n")
    messages = message_stream(spark, str(landed), maxFilesPerTrigger=1)
    query = run_messages(messages, f"{tmp_path}/lines", f"{tmp_path}/checkpoints", now=True)
    query.awaitTermination()
    counts = [p["observedMetrics"]["written"]["lines"] for p in query.recentProgress if p["numInputRows"]]
    assert counts == [2, 2, 2]
    read = [p["observedMetrics"]["read"].asDict() for p in query.recentProgress if p["numInputRows"]]
    assert read == [{"messages": 2, "unreadable": 1}] * 3
    got = sorted(r.value for r in spark.read.text(f"{tmp_path}/lines").collect())
    assert got == ["Title: No title | Published At: Unknown date"] * 3 + [
        f"Title: t{i} | Published At: 2024" for i in range(3)
    ]


def test_failing_sink_fails_the_query_and_is_repeated(spark, headlines, tmp_path):
    def fail(df, batch_id):
        raise RuntimeError("no table")

    lines = stream(spark, headlines)
    with pytest.raises(StreamingQueryException):
        start(lines, [batch_table(f"{tmp_path}/out"), fail], f"{tmp_path}/checkpoint").awaitTermination()
    start(lines, [batch_table(f"{tmp_path}/out")], f"{tmp_path}/checkpoint").awaitTermination()
    assert read_batches(spark, f"{tmp_path}/out").count() == 7


def test_waiting_sees_the_failure_of_any_query(spark, headlines, tmp_path):
    def fail(df, batch_id):
        raise RuntimeError("no table")

    good = start(stream(spark, headlines), batch_table(f"{tmp_path}/out"), f"{tmp_path}/one", every="1 second")
    bad = start(stream(spark, headlines), fail, f"{tmp_path}/two", every="1 second")
    with pytest.raises(StreamingQueryException):
        wait([good, bad])
    assert not good.isActive and not bad.isActive


def test_waiting_ends_with_the_queries(spark, headlines, tmp_path):
    queries = [start(stream(spark, headlines), batch_table(f"{tmp_path}/{n}"), f"{tmp_path}/c{n}") for n in "ab"]
    wait(queries)
    assert read_batches(spark, f"{tmp_path}/a").count() == read_batches(spark, f"{tmp_path}/b").count() == 7


def test_empty_batches_reach_no_sink(spark):
    seen = []
    handle = fan_out([lambda df, batch_id: seen.append(batch_id)])
    handle(spark.createDataFrame([], "value string"), 1)
    handle(spark.createDataFrame([("a",)], "value string"), 2)
    assert seen == [2]


def test_watermark_drops_old_windows(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    at = lambda minutes: (AS_OF + dt.timedelta(minutes=minutes)).isoformat()
    schema = "t string, ts timestamp"
    for i, minutes in enumerate([[0, 1], [60], [61], [0, 62]]):
        path = folder / f"{i}.json"
        path.write_text("".join(json.dumps({"t": "a", "ts": at(m)}) + "\n" for m in minutes))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(folder))
    topic_query(
        events, batch_table(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", None, "t", "ts", watermark="5 minutes"
    ).awaitTermination()
    windows = [r.time_window for r in read_batches(spark, f"{tmp_path}/out").collect()]
    assert windows.count(AS_OF) == 1  # the late row at minute 0 is left out
    assert AS_OF + dt.timedelta(minutes=62) in windows


def test_entity_job_survives_its_first_triggers(spark, headlines, tmp_path):
    """The trending query starts before there is a table of entities."""
    schema = extract_entities(spark.createDataFrame([], "value string"), "value").schema
    entities = HourlyTable(f"{tmp_path}/entities", "detected_at", schema)
    sinks = {
        "streaming_articles": batch_table(f"{tmp_path}/articles"),
        "extracted_entities": entities,
        "trending_entities": replaced_table(f"{tmp_path}/trending"),
    }
    assert entities.read(spark).count() == 0
    recent = lambda: entities.read(spark, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(hours=1))
    queries = run_entities(stream(spark, headlines), sinks, recent, f"{tmp_path}/checkpoints", now=False)
    try:
        for query in queries:
            query.processAllAvailable()
        assert all(query.isActive for query in queries)
    finally:
        for query in queries:
            query.stop()
    expected = extract_entities(spark.read.text(headlines), "value")
    assert rows(entities.read(spark), "detected_at") == rows(expected, "detected_at")


def test_hourly_table_prunes_replaces_and_compacts(spark, tmp_path):
    at = lambda hour: dt.datetime(2024, 1, 30, 22) + dt.timedelta(hours=hour)
    make = lambda *hours: spark.createDataFrame([(h, at(h)) for h in hours], "h int, t timestamp")
    table = HourlyTable(f"{tmp_path}/t", "t", "h int, t timestamp")
    table(make(0, 1, 1), 0)
    table(make(1, 2, 3), 1)
    table(make(1, 2, 3), 1)  # repeated
    assert sorted(r.h for r in table.read(spark).collect()) == [0, 1, 1, 1, 2, 3]
    late = table.read(spark, at(2))
    assert sorted(r.h for r in late.collect()) == [2, 3]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((day" in plan
    table.compact(spark, "2024-01-30", 23)
    assert sorted(r.h for r in table.read(spark).collect()) == [0, 1, 1, 1, 2, 3]
    assert len([p for p in (tmp_path / "t/day=2024-01-30/hour=23").iterdir() if p.is_dir()]) == 1


def test_replaced_result_is_whole_or_not_there(spark, tmp_path):
    path = f"{tmp_path}/out"
    assert read_replaced(spark, path, "id long").count() == 0
    with pytest.raises(FileNotFoundError):
        read_replaced(spark, path)
    write = replaced_table(path)
    write(spark.range(3), 0)
    with pytest.raises(Exception):
        write(spark.range(5).select(F.raise_error("broken").alias("id")), 1)
    assert read_replaced(spark, path).count() == 3  # the failed write hides nothing
    begun = read_replaced(spark, path)
    write(spark.range(7), 2)
    assert read_replaced(spark, path).count() == 7 and begun.count() == 3


def test_merged_table_drops_what_has_expired(spark, tmp_path):
    sink = merged_table(f"{tmp_path}/out", ["k"], F.col("until") > 1)
    make = lambda *given: spark.createDataFrame(list(given), "k string, n int, until int")
    sink(make(("a", 1, 2), ("b", 1, 5), ("c", 1, 1)), 0)
    sink(make(("b", 2, 5), ("d", 1, 9)), 1)
    assert rows(read_replaced(spark, f"{tmp_path}/out")) == [("a", 1, 2), ("b", 2, 5), ("d", 1, 9)]


def test_word_cloud_state_is_bounded(spark, tmp_path):
    folder = tmp_path / "news"
    folder.mkdir()
    for i in range(6):
        path = folder / f"{i}.json"
        path.write_text(json.dumps({"title": f"mot{chr(97 + i) * 4} toujours", "topic": "t", "ts": (AS_OF + dt.timedelta(hours=3 * i)).isoformat()}) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    news = spark.readStream.schema("title string, topic string, ts timestamp").option("maxFilesPerTrigger", 1).json(str(folder))
    query = word_cloud_query(news, merged_table(f"{tmp_path}/out", CLOUD_KEYS), f"{tmp_path}/checkpoint", None, ts_col="ts", tasks=2)
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) <= 4  # two words of each of the windows that are still open
    found = read_replaced(spark, f"{tmp_path}/out")
    assert found.where("word = 'toujours'").count() == 6  # once in each window
