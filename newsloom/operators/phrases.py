"""Named-entity tags for tokens: phrases of a gazetteer, then runs of capitalised words.

Matching is leftmost-longest. A gazetteer of checked size travels to the tasks as a trie that the
tokens walk (`trie`). Of a larger one a filter of fixed size travels (`phrase_filter`): the runs of words
that it lets through are joined with the phrases themselves, and from a document's hits the matches
are taken from the left, the longest first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import EN_STOP
from ..functions import settle
from ..word_shapes import NAME_SHAPE, NAME_TYPE
from .lexicon import BROADCAST_ROWS, content_key, fits, lookup, saved
from .phrase_filter import CANDIDATES, LARGEST, candidates, known_words, phrase_filter, word_filter
from .trie import OUTSIDE, PhraseTrie, build_trie, walker


def normalize_gazetteer(gazetteer: DataFrame) -> DataFrame:
    """(phrase, entity_type, n): words joined by one blank, one type per phrase."""
    words = F.filter(F.split("phrase", r"\s+"), lambda w: w != "")
    return (
        gazetteer.select(F.array_join(words, " ").alias("phrase"), "entity_type")
        .where((F.length("phrase") > 0) & F.col("entity_type").isNotNull())
        .groupBy("phrase")
        .agg(F.min("entity_type").alias("entity_type"))
        .withColumn("n", F.size(F.split("phrase", " ")))
    )


@dataclass
class Gazetteer:
    """A gazetteer made ready once, for any number of batches."""

    table: DataFrame  # normalized and saved
    lengths: list[int]  # numbers of words of its phrases, the largest first
    trie: PhraseTrie | None  # the phrases, if they travel to the tasks
    sieve: np.ndarray | None = None  # else their filter, if it holds them well


def prepare_gazetteer(gazetteer: DataFrame | Gazetteer, carry_phrases: int = BROADCAST_ROWS) -> Gazetteer:
    """Normalize, size and save a (phrase, entity_type) gazetteer. Up to `carry_phrases` phrases of
    checked size travel to the tasks as a trie; a larger one is joined, with the same result."""
    if isinstance(gazetteer, Gazetteer):
        return gazetteer
    table = saved(normalize_gazetteer(gazetteer), "gazetteer")
    lengths = sorted((row["n"] for row in table.select("n").distinct().collect()), reverse=True)
    if not fits(table, carry_phrases):
        entries = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return Gazetteer(table, lengths, None, phrase_filter(table, entries) if entries <= LARGEST else None)
    entries = table.select("phrase", "entity_type").toArrow()
    return Gazetteer(table, lengths, build_trie(entries.column("phrase"), entries.column("entity_type")))


def _key(n, gram) -> Column:
    """A phrase with its number of words: a token that holds a blank is no phrase of two words."""
    return F.concat(n if isinstance(n, Column) else F.lit(str(n)), F.lit(" "), gram)


def _sieve(df: DataFrame, tokens: str, gazetteer: Gazetteer):
    """The phrases that are joined, and their filter. Of more phrases than a filter holds well, those are left
    whose words are all among the tokens: no other can match."""
    if gazetteer.sieve is not None:
        return gazetteer.table, gazetteer.sieve
    known = F.arrow_udf(known_words(word_filter(df, tokens)), "boolean")
    table = saved(gazetteer.table.where(known(F.split("phrase", " "))), "known-phrases")
    return table, phrase_filter(table, table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def _joined_tags(df: DataFrame, tokens: str, gazetteer: Gazetteer, out: str) -> DataFrame:
    """The tags by a join with a gazetteer too large to travel. A filter of fixed size does travel, and only the runs
    of words that it lets through are joined.

    Matches depend on the tokens alone, so they are put together by content: no id is needed.
    """
    table, sieve = _sieve(df, tokens, gazetteer)
    entries = table.select(_key(F.col("n").cast("string"), F.col("phrase")).alias("phrase"), "entity_type")
    keyed = settle(df, "_key", F.unhex(content_key(tokens)))
    seen = keyed.select("_key", F.col(tokens).alias("_words"))
    seen = settle(seen.withColumn("_at", F.arrow_udf(candidates(sieve), CANDIDATES)("_words")), "_at", F.col("_at"))
    grams = F.transform("_at", lambda run: F.struct(
        run["pos"].alias("pos"), run["n"].alias("n"),
        _key(run["n"].cast("string"), F.array_join(F.slice("_words", run["pos"] + 1, run["n"]), " ")).alias("phrase"),
    ))
    grams = saved(seen.select("_key", F.inline(grams)), "candidates")  # the join reads it twice
    hits = (
        lookup(grams, entries, "phrase", "inner")
        .groupBy("_key")
        .agg(F.array_sort(F.collect_set(F.struct("pos", (-F.col("n")).alias("by"), "entity_type"))).alias("_hits"))
    )
    none = F.array().cast(hits.schema["_hits"].dataType)
    found = settle(keyed.join(hits.hint("merge"), "_key", "left"), "_hits", F.coalesce("_hits", none))
    return settle(found.withColumn(out, F.arrow_udf(_leftmost(), "array<string>")(tokens, "_hits")), out, F.col(out)).drop("_key", "_hits")


def _leftmost():
    """A function from token arrays and their hits, in order and the longest first, to IOB tags."""
    outside = OUTSIDE

    # Inner functions travel to the workers by value: these need not have this package.

    def tags(tokens: pa.Array, hits: pa.Array) -> pa.Array:
        offsets = tokens.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        bounds = hits.offsets.to_numpy().astype(np.int64)
        flat = hits.values.slice(bounds[0], bounds[-1] - bounds[0])
        places = pc.struct_field(flat, "pos").to_numpy().astype(np.int64) + np.repeat(offsets[:-1], np.diff(bounds))
        sizes = -pc.struct_field(flat, "by").to_numpy().astype(np.int64)
        kinds = pc.struct_field(flat, "entity_type").cast(pa.string()).dictionary_encode()
        names = pa.array([outside, *(f"{mark}-{one}" for one in kinds.dictionary.to_pylist() for mark in "BI")])
        taken, free = [], 0
        for i, (place, size) in enumerate(zip(places.tolist(), sizes.tolist())):
            if place >= free:  # no phrase reaches over the end of a document
                taken.append(i)
                free = place + size
        begins, size = places[taken], sizes[taken]
        kind = kinds.indices.to_numpy().astype(np.int64)[taken]
        codes = np.zeros(offsets[-1], np.int64)
        codes[np.repeat(begins - np.cumsum(size) + size, size) + np.arange(size.sum())] = np.repeat(2 * kind + 2, size)
        codes[begins] = 2 * kind + 1
        missing = tokens.is_null() if tokens.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names.take(pa.array(codes)), mask=missing)

    return tags


def match_phrases(
    df: DataFrame,
    gazetteer: DataFrame | Gazetteer,
    tokens_col: str = "token",
    out: str = "ner",
    carry_phrases: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add IOB tags for the leftmost-longest phrases of a (phrase, entity_type) gazetteer.

    The phrases travel to the tasks as a trie of checked size, and no row moves; a larger gazetteer
    is joined with the n-grams of the documents, with the same result. A gazetteer used again, as in
    a stream, goes through `prepare_gazetteer` once.
    """
    ready = prepare_gazetteer(gazetteer, carry_phrases)
    if not ready.lengths:
        return settle(df, out, F.transform(tokens_col, lambda _: F.lit(OUTSIDE)))
    if ready.trie is not None:
        walked = F.arrow_udf(walker(ready.trie), "array<string>")
        return settle(df.withColumn(out, walked(tokens_col)), out, F.col(out))
    return _joined_tags(df, tokens_col, ready, out)


def is_name(tokens_col: str, tags_col: str, ignore=EN_STOP) -> Column:
    """Per token, whether it is a capitalised word without a tag and not a listed word."""
    ignored = [w.lower() for w in ignore]
    return F.transform(
        F.arrays_zip(F.col(tokens_col).alias("token"), F.col(tags_col).alias("tag")),
        lambda z: F.coalesce(
            (z["tag"] == OUTSIDE) & z["token"].rlike(NAME_SHAPE) & ~F.lower(z["token"]).isin(ignored), F.lit(False)
        ),
    )


def ner_tag(
    df: DataFrame,
    gazetteer: DataFrame | Gazetteer | None = None,
    tokens_col: str = "token",
    out: str = "ner",
    names: bool = True,
    ignore=EN_STOP,
    entity_type: str = NAME_TYPE,
    **match_args,
) -> DataFrame:
    """Add one IOB tag per token: gazetteer phrases first, then capitalised words."""
    if gazetteer is not None:
        df = match_phrases(df, gazetteer, tokens_col, out, **match_args)
    else:
        df = settle(df, out, F.transform(tokens_col, lambda _: F.lit(OUTSIDE)))
    if not names:
        return df
    begin, inside = f"B-{entity_type}", f"I-{entity_type}"
    tagged = settle(df, "_name", is_name(tokens_col, out, ignore))
    merged = F.transform(
        out,
        lambda tag, i: F.when(~F.get("_name", i), tag)
        .when(F.coalesce(F.get("_name", i - 1), F.lit(False)), inside)
        .otherwise(begin),
    )
    return settle(tagged, out, merged).drop("_name")
