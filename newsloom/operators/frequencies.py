"""Document frequencies that follow a changing corpus.

A table of signed counts: documents that come add one for each of their distinct terms, documents that go
take it away, and a row without a term counts the documents themselves. Tables are merged by summing, in
any order, so IDF is brought up to date by the changes alone, without a new pass over the corpus.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .lexicon import even_join, saved
from .tfidf import term_frequencies


def frequency_changes(df: DataFrame, terms_col: str = "token", change_col: str | None = None) -> DataFrame:
    """(term, df): what the documents change. Each counts 1, or what `change_col` holds: 1 for one that
    comes and -1 for one that goes, whose terms have to be given. A changed document is both."""
    change = (F.lit(1) if change_col is None else F.col(change_col)).cast("long")
    terms = F.filter(F.array_distinct(terms_col), lambda term: term.isNotNull())
    none = F.array().cast("array<string>")
    whole = F.array(F.lit(None).cast("string"))
    return merge_frequencies(
        df.select(F.explode(F.concat(whole, F.coalesce(terms, none))).alias("term"), change.alias("df"))
    )


def merge_frequencies(*tables: DataFrame) -> DataFrame:
    """The sum of (term, df) tables; terms that no document has any more are left out."""
    rows = reduce(DataFrame.unionByName, [table.select("term", "df") for table in tables])
    return rows.groupBy("term").agg(F.sum("df").alias("df")).where(F.col("df") != 0)


def inverse_frequencies(frequencies: DataFrame) -> DataFrame:
    """(term, df, idf) with idf = ln((m + 1) / (df + 1)), from a merged table that can be read twice."""
    m = frequencies.where(F.col("term").isNull()).agg(F.coalesce(F.sum("df"), F.lit(0)).alias("m")).scalar()
    idf = F.log((m + 1).cast("double") / (F.col("df") + 1))
    return frequencies.where(F.col("term").isNotNull()).select("term", "df", idf.alias("idf"))


def weigh_terms(
    df: DataFrame, frequencies: DataFrame, id_col: str = "doc_id", terms_col: str = "token", shares: int | None = None
) -> DataFrame:
    """(id, term, tf, df, tfidf) of documents by a merged table of frequencies, which may be of another
    corpus; a term it does not have is in no document. The frequencies are written once and merged; terms
    that are hot in `df` are broadcast (`even_join`)."""
    frequencies = saved(frequencies, "document-frequencies")
    count = frequencies.where(F.col("term").isNull()).agg(F.coalesce(F.sum("df"), F.lit(0)).alias("m")).first()["m"]
    tf = term_frequencies(df, id_col, terms_col).where(F.col("term").isNotNull())
    found = even_join(tf, inverse_frequencies(frequencies), "term", shares=shares)
    idf = F.coalesce("idf", F.log(F.lit(float(count + 1))))
    return found.select(
        id_col, "term", "tf", F.coalesce("df", F.lit(0).cast("long")).alias("df"), (F.col("tf") * idf).alias("tfidf")
    )
