"""Word cloud: how often each word occurs per topic, and how it is drawn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import BUCKETS, CLOUD_CATEGORY, CLOUD_LIFETIME, FR_STOP, OTHER_STYLE
from ..functions import keep_letters, moment, white_split


def word_frequencies(
    df: DataFrame, text_col: str, topic_col: str, stopwords=FR_STOP, min_len: int = 4, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(word, topic, frequency), and for each value of the `keep` columns. The topic must be a column already: computed beside the
    explode it would be worked out anew for every word."""
    words = df.select(
        F.explode(white_split(keep_letters(text_col))).alias("word"), F.col(topic_col).alias("topic"), *keep
    )
    return (
        words.where((F.length("word") >= min_len) & ~F.col("word").isin(list(stopwords)))
        .groupBy("word", "topic", *keep)
        .agg(F.count("*").alias("frequency"))
    )


def _by_frequency(values, other) -> Column:
    picked = None
    for bound, value in values:
        above = F.col("frequency") > bound
        picked = F.when(above, value) if picked is None else picked.when(above, value)
    return picked.otherwise(other)


def style_words(
    frequencies: DataFrame, buckets=BUCKETS, other=OTHER_STYLE, as_of=None, keep: tuple[str, ...] = ()
) -> DataFrame:
    return frequencies.select(
        *keep,
        "word",
        "topic",
        "frequency",
        F.col("frequency").cast("double").alias("weight"),
        _by_frequency([(bound, size) for bound, size, _ in buckets], other[0]).alias("font_size"),
        _by_frequency([(bound, color) for bound, _, color in buckets], other[1]).alias("color"),
        F.lit(CLOUD_CATEGORY).alias("category"),
        (moment(as_of) + F.expr(f"interval {CLOUD_LIFETIME}")).alias("expires_at"),
    )


def word_cloud(
    df: DataFrame,
    text_col: str,
    topic_col: str,
    stopwords=FR_STOP,
    min_len: int = 4,
    buckets=BUCKETS,
    as_of=None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    return style_words(
        word_frequencies(df, text_col, topic_col, stopwords, min_len, keep), buckets, as_of=as_of, keep=keep
    )


def unexpired(cloud: DataFrame, as_of=None) -> DataFrame:
    """Word-cloud entries still to be shown."""
    return cloud.where(F.col("expires_at") > moment(as_of))
