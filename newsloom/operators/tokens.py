"""Documents to tokens, in two shapes.

* one row per document with a `token` array: every step stays inside the row, without a shuffle;
* one row per token (`doc_id`, `pos`, `token`): for joins with lexicon tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import EN_STOP
from ..functions import settle, strip_punctuation, white_split
from .lexicon import look_up_arrays, lookup


def assemble(df: DataFrame, text_col: str = "text", id_col: str | None = "doc_id") -> DataFrame:
    """Keep the id and the text without punctuation. The id comes from the data."""
    kept = [id_col] if id_col else []
    return df.select(*kept, strip_punctuation(text_col).alias("text"))


def tokens_of(text) -> Column:
    return F.filter(white_split(text), lambda word: word != "")


def tokenize(df: DataFrame, text_col: str = "text", out: str = "token") -> DataFrame:
    return settle(df, out, tokens_of(text_col))


def token_rows(df: DataFrame, id_col: str = "doc_id", tokens_col: str = "token") -> DataFrame:
    return df.select(id_col, F.posexplode(tokens_col).alias("pos", "token"))


def remove_stopwords(
    df: DataFrame, words=EN_STOP, tokens_col: str = "token", out: str = "cleanTokens"
) -> DataFrame:
    """Drop listed words from the token arrays, whatever their case. A list is part of the plan; a
    table of words (its first column, as `read_wordlist` gives it) is looked up in the row."""
    if isinstance(words, DataFrame):
        lowered = settle(df, "_lowered", F.transform(tokens_col, F.lower))
        found = look_up_arrays(lowered, _listed(words), "listed", "_lowered", "_listed")
        kept = F.filter(tokens_col, lambda _, i: F.get("_listed", i).isNull())
        return settle(found, out, kept).drop("_lowered", "_listed")
    listed = [w.lower() for w in words]
    return settle(df, out, F.filter(tokens_col, lambda token: ~F.lower(token).isin(listed)))


def drop_stopwords(rows: DataFrame, words: DataFrame, token_col: str = "token") -> DataFrame:
    """Token rows (or counted tokens) without the words of a table, whatever their case. A list of
    checked size is broadcast; a larger one is joined so that no frequent word is a task of its own."""
    listed = _listed(words).withColumnRenamed("token", "_word").distinct()
    found = lookup(rows.withColumn("_word", F.lower(token_col)), listed, "_word")
    return found.where(F.col("listed").isNull()).select(*rows.columns)


def _listed(words: DataFrame) -> DataFrame:
    return words.select(F.lower(words.columns[0]).alias("token"), F.lit("x").alias("listed")).where("token is not null")


def finish(df: DataFrame, annotation_col: str = "lemma", out: str = "finished_lemma") -> DataFrame:
    """Annotations to plain strings; the annotations stay."""
    return df.withColumn(out, F.col(f"{annotation_col}.result"))
