"""TF-IDF, as hashed vectors and per term."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import settle
from .lexicon import even_join, lemmatize, saved
from .tokens import drop_stopwords

NUM_FEATURES = 1000


def hashing_tf(df: DataFrame, terms_col: str, out: str = "rawFeatures", num_features: int = NUM_FEATURES) -> DataFrame:
    from pyspark.ml.feature import HashingTF

    return HashingTF(inputCol=terms_col, outputCol=out, numFeatures=num_features).transform(df)


def idf(df: DataFrame, features_col: str = "rawFeatures", out: str = "features") -> DataFrame:
    """Scale by ln((m + 1) / (df + 1)); fitting is one pass that sums fixed-size vectors."""
    from pyspark.ml.feature import IDF

    return IDF(inputCol=features_col, outputCol=out).fit(df).transform(df)


def tfidf(df: DataFrame, terms_col: str = "finished_lemma", num_features: int = NUM_FEATURES) -> DataFrame:
    return idf(hashing_tf(df, terms_col, num_features=num_features))


def term_frequencies(df: DataFrame, id_col: str = "doc_id", terms_col: str = "token") -> DataFrame:
    """(id, term, tf) of each document, counted inside the row: the terms are sorted and each run
    of equal terms is one row, so nothing is shuffled."""
    runs = settle(df.select(id_col, terms_col), "_terms", F.sort_array(terms_col)).select(id_col, "_terms")
    runs = runs.withColumn("_size", F.size("_terms")).where(F.col("_size") > 0)
    starts = F.filter(
        F.sequence(F.lit(0), F.col("_size") - 1),
        lambda i: (i == 0) | (F.get("_terms", i) != F.get("_terms", i - 1)),
    )
    runs = settle(runs, "_starts", starts)
    counted = F.transform(
        "_starts",
        lambda start, i: F.struct(
            F.get("_terms", start).alias("term"),
            (F.coalesce(F.get("_starts", i + 1), F.col("_size")) - start).alias("tf"),
        ),
    )
    return runs.select(id_col, F.inline(counted))


def term_tfidf(
    df: DataFrame,
    id_col: str = "doc_id",
    terms_col: str = "token",
    lexicon: DataFrame | None = None,
    stopwords: DataFrame | None = None,
    documents: DataFrame | None = None,
    shares: int | None = None,
) -> DataFrame:
    """(id, term, tf, df, tfidf) with tfidf = tf * ln((m + 1) / (df + 1)).

    `stopwords` is a table of words to leave out, `lexicon` a (token, lemma) table. `documents` is
    a table with as many rows as `df` that is cheaper to count, such as the one `df` was made of.

    The document frequencies are as long as the vocabulary, so they are written once and merged;
    only the terms that more documents have than a task's even share are broadcast (`even_join`).
    """
    terms = df.select(F.explode(F.array_distinct(terms_col)).alias("term"))
    tf = term_frequencies(df, id_col, terms_col)
    if stopwords is not None:
        tf = drop_stopwords(tf, stopwords, "term")
        terms = drop_stopwords(terms, stopwords, "term")
    if lexicon is not None:
        tf = (
            lemmatize(tf, lexicon, "term")
            .groupBy(id_col, F.col("lemma").alias("term"))
            .agg(F.sum("tf").cast("int").alias("tf"))
        )
        terms = tf
    m = (df if documents is None else documents).agg(F.count("*").alias("m")).scalar()
    weighted = saved(
        terms.groupBy("term")
        .agg(F.count("*").alias("df"))
        .withColumn("_idf", F.log((m + 1).cast("double") / (F.col("df") + 1))),
        "document-frequencies",
    )
    counts = weighted.select("term", F.col("df").alias("_n"))
    return even_join(tf, weighted, "term", "inner", counts, shares).select(
        id_col, "term", "tf", "df", (F.col("tf") * F.col("_idf")).alias("tfidf")
    )
