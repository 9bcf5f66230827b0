"""Keyword and part-of-speech counts.

Tokens are counted first and looked up afterwards: the lexicon is joined with the vocabulary
instead of the corpus, and no key is ever hot in the join. How to join the two is left to the
optimizer, which knows both sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import EN_STOP
from ..word_shapes import POS_SHAPES
from .lexicon import normalize_lexicon, shape_tag
from .tokens import drop_stopwords


def token_counts(df: DataFrame, tokens_col: str = "token") -> DataFrame:
    return df.select(F.explode(tokens_col).alias("token")).groupBy("token").count()


def _summed(rows: DataFrame, key: str, k: int | None) -> DataFrame:
    ordered = rows.groupBy(key).agg(F.sum("count").alias("count")).orderBy(F.desc("count"), key)
    return ordered if k is None else ordered.limit(k)


def keyword_counts(
    df: DataFrame,
    lexicon: DataFrame | None = None,
    stopwords=EN_STOP,
    min_len: int = 2,
    k: int | None = None,
    tokens_col: str = "token",
) -> DataFrame:
    """(word, count) of the lemmas that are no stop words and have `min_len` characters.

    `stopwords` is a list or a table of words, `lexicon` a (token, lemma) table.
    """
    counted = token_counts(df, tokens_col)
    if isinstance(stopwords, DataFrame):
        counted = drop_stopwords(counted, stopwords)
    else:
        counted = counted.where(~F.lower("token").isin([w.lower() for w in stopwords]))
    word = F.col("token")
    if lexicon is not None:
        counted = counted.join(normalize_lexicon(lexicon, "lemma"), "token", "left")
        word = F.coalesce("lemma", "token")
    words = counted.select(word.alias("word"), "count").where(F.length("word") >= min_len)
    return _summed(words, "word", k)


def pos_frequencies(
    df: DataFrame, lexicon: DataFrame, k: int | None = 20, shapes=POS_SHAPES, tokens_col: str = "token"
) -> DataFrame:
    """(pos_tag, count) over all tokens, by the same rule as `lexicon.pos_tag`."""
    entries = normalize_lexicon(lexicon, "tag", fold=True).withColumnRenamed("token", "_lowered")
    tagged = (
        token_counts(df, tokens_col)
        .withColumn("_lowered", F.lower("token"))
        .join(entries, "_lowered", "left")
        .select(F.coalesce("tag", shape_tag("token", shapes)).alias("pos_tag"), "count")
    )
    return _summed(tagged, "pos_tag", k)
