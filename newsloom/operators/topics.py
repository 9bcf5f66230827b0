"""Topic classification and topic trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import ARTICLE_SOURCE, OTHER_TOPIC, TOPIC_RULES
from ..functions import any_word, lower_case, settle

_LOWERED = "_lowered"


def classify_topic(
    df: DataFrame,
    text_col: str,
    rules=TOPIC_RULES,
    whole_word: bool = False,
    out: str = "detected_topic",
    other: str = OTHER_TOPIC,
) -> DataFrame:
    """Add the topic of the first rule that has a word in the text.

    Words match inside longer words too; `whole_word` asks for whole words only. The lower-cased
    text is a column of its own, so that it is made once and not once per word.
    """
    topic = None
    for name, words in rules:
        found = any_word(_LOWERED, words, whole_word)
        topic = F.when(found, name) if topic is None else topic.when(found, name)
    return settle(df.withColumn(_LOWERED, lower_case(text_col)), out, topic.otherwise(other)).drop(_LOWERED)


def topic_counts(df: DataFrame, topic_col: str = "detected_topic") -> DataFrame:
    return (
        df.groupBy(F.col(topic_col).alias("topic"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "topic")
    )


def topic_trends(
    df: DataFrame,
    topic_col: str,
    ts_col: str,
    window: str = "1 minutes",
    factor: float = 2.0,
    source: str = ARTICLE_SOURCE,
    watermark: str | None = None,
) -> DataFrame:
    """Count topics in tumbling windows; `watermark` bounds the state of an endless stream.

    Both aggregates combine before the shuffle, so a topic that holds most rows costs one
    row per task and window.
    """
    if watermark is not None:
        df = df.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)
    counted = df.groupBy(
        F.col(topic_col).alias("topic"), F.window(ts_col, window).alias("window")
    ).agg(F.count("*").alias("count"), F.max(ts_col).alias("last_seen"))
    return counted.select(
        "topic",
        "count",
        (F.col("count").cast("double") * factor).alias("trend_score"),
        F.col("window.start").alias("time_window"),
        F.lit(window).alias("window_duration"),
        F.col("window.start").alias("first_seen"),
        "last_seen",
        F.col("count").alias("peak_count"),
        F.array(F.lit(source)).alias("sources"),
    )
