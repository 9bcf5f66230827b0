"""The batch analysis of a corpus: entities, part-of-speech tags, keywords and TF-IDF."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import EN_STOP
from ..operators import (
    EntityTagger, assemble, entity_counts, entity_type_counts, iob_to_chunks, keyword_counts, pos_frequencies,
    remove_stopwords, tag_entities, term_tfidf, tokenize,
)

Write = Callable[[DataFrame, str, str], None]


def batch_results(
    corpus: DataFrame,
    pos_lexicon: DataFrame,
    lemma_lexicon: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
    stopwords=EN_STOP,
    date=None,
    annotated_path: str | None = None,
    tagger: EntityTagger | None = None,
) -> dict[str, DataFrame]:
    """All result tables of a (doc_id, text) corpus. Names outside the gazetteer get their types from a
    learned `tagger` (`train_entity_tagger`), if there is one.

    With `annotated_path` the tokens and entities are written there once and every result reads
    only the columns it needs, instead of annotating the corpus anew for each.
    """
    annotated = iob_to_chunks(tag_entities(tokenize(assemble(corpus)), gazetteer, tagger)).select("doc_id", "token", "entities")
    if annotated_path is not None:
        annotated.write.mode("overwrite").parquet(annotated_path)
        annotated = corpus.sparkSession.read.parquet(annotated_path)
    if isinstance(stopwords, DataFrame):
        tfidf = term_tfidf(annotated, lexicon=lemma_lexicon, stopwords=stopwords, documents=corpus)
    else:
        tfidf = term_tfidf(remove_stopwords(annotated, stopwords, out="token"), lexicon=lemma_lexicon, documents=corpus)
    return {
        "top_entities": entity_counts(annotated),
        "entity_counts": entity_type_counts(annotated, date),
        "pos_frequencies": pos_frequencies(annotated, pos_lexicon),
        "keyword_counts": keyword_counts(annotated, lemma_lexicon, stopwords),
        "tfidf": tfidf,
    }


def run_batch(corpus: DataFrame, write: Write, **results_args) -> dict[str, DataFrame]:
    """Write the keyword and entity tables with `write(df, table, mode)`; return all results."""
    results = batch_results(corpus, **results_args)
    write(results["keyword_counts"].select("word", F.col("count")), "keyword_counts", "overwrite")
    write(results["entity_counts"], "entity_counts", "append")
    return results
