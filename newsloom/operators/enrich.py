"""Article enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import (
    ARTICLE_CONTENT, ARTICLE_LANGUAGE, ARTICLE_SOURCE, ARTICLE_STATUS, TOPIC_RULES, URL_PREFIX,
    URL_TIME_FORMAT,
)
from ..functions import moment, word_count
from .topics import classify_topic

ARTICLE_COLUMNS = [
    "title", "content", "topic", "source", "url", "published_date", "received_date",
    "processed_date", "word_count", "language", "sentiment_score", "processing_status",
]


def enrich_articles(
    df: DataFrame,
    text_col: str = "value",
    ts=None,
    language: str = ARTICLE_LANGUAGE,
    source: str = ARTICLE_SOURCE,
    rules=TOPIC_RULES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Headlines to article rows. `ts` is the arrival time, by default the current time.

    All rows of a micro-batch share one timestamp, so a hash of the text is added to the
    timestamp of the URL to tell them apart. A null headline has a URL too: that of an empty one.
    """
    received = moment(F.col(ts) if isinstance(ts, str) else ts)
    url = F.concat(
        F.lit(URL_PREFIX), F.date_format(received, URL_TIME_FORMAT), F.lit("-"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))),
    )
    return classify_topic(df, text_col, rules, out="topic").select(
        *keep,
        F.col(text_col).alias("title"),
        F.lit(ARTICLE_CONTENT).alias("content"),
        "topic",
        F.lit(source).alias("source"),
        url.alias("url"),
        received.alias("published_date"),
        received.alias("received_date"),
        moment(None if ts is None else received).alias("processed_date"),
        word_count(text_col).alias("word_count"),
        F.lit(language).alias("language"),
        F.lit(None).cast("decimal(3,2)").alias("sentiment_score"),
        F.lit(ARTICLE_STATUS).alias("processing_status"),
    )
