import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.operators import classify_topic, enrich_articles, topic_counts, topic_trends
from newsloom.operators.enrich import ARTICLE_COLUMNS


@pytest.mark.parametrize("text, topic, whole", [
    ("Le sport et la tech", "sport", "sport"),
    ("social media", "intelligence_artificielle", "général"),
    ("Une IA, vraiment", "intelligence_artificielle", "intelligence_artificielle"),
    ("ÉCOLOGIE et bourse", "climat_environnement", "climat_environnement"),
    ("Covid et médecine", "santé_médecine", "santé_médecine"),
    ("biotechnologie", "technologie", "général"),
    ("rien", "général", "général"),
    ("", "général", "général"),
])
def test_rules(texts, text, topic, whole):
    df = texts(text)
    assert classify_topic(df, "text").first().detected_topic == topic
    assert classify_topic(df, "text", whole_word=True).first().detected_topic == whole


def test_own_rules_and_counts(texts):
    df = classify_topic(texts("b a", "b", "c"), "text", [("first", ["a"]), ("second", ["b"])], other="none")
    assert [tuple(r) for r in topic_counts(df).collect()] == [("first", 1), ("none", 1), ("second", 1)]


def test_article_columns(texts):
    ts = F.lit("2024-05-06 07:08:09.123").cast("timestamp")
    row = enrich_articles(texts("Le tennis en ligne"), "text", ts=ts).first()
    assert list(row.asDict()) == ARTICLE_COLUMNS
    assert row.topic == "sport" and row.word_count == 4 and row.language == "fr"
    assert row.source == "CLI_Stream" and row.content == "Contenu généré automatiquement"
    assert row.processing_status == "completed" and row.sentiment_score is None
    assert row.url.startswith("socket://streaming/20240506070809123-")


def test_article_urls_differ_within_a_batch(texts):
    urls = [r.url for r in enrich_articles(texts("a", "b", "c"), "text").collect()]
    assert len(set(urls)) == 3 and len({u.split("-")[0] for u in urls}) == 1


def test_article_schema(texts):
    types = dict(enrich_articles(texts("a"), "text").dtypes)
    assert types["sentiment_score"] == "decimal(3,2)"
    assert types["word_count"] == "int"
    assert types["received_date"] == types["published_date"] == types["processed_date"] == "timestamp"


def test_trend_windows_are_half_open(spark):
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=s)
    df = spark.createDataFrame([("a", at(0)), ("a", at(59.999)), ("a", at(60)), ("b", at(1))], "t string, ts timestamp_ntz")
    rows = {(r.topic, r.time_window): r for r in topic_trends(df, "t", "ts").collect()}
    assert {k: r["count"] for k, r in rows.items()} == {("a", at(0)): 2, ("a", at(60)): 1, ("b", at(0)): 1}
    first = rows["a", at(0)]
    assert first.trend_score == 4.0 and first.peak_count == 2 and first.first_seen == at(0)
    assert first.last_seen == at(59.999) and first.window_duration == "1 minutes" and first.sources == ["CLI_Stream"]
