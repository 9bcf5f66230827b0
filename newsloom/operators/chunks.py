"""IOB tags to entity chunks, inside the row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import settle
from .phrases import OUTSIDE

CHUNKS = "array<struct<result:string,metadata:map<string,string>>>"


def iob_to_chunks(
    df: DataFrame, tokens_col: str = "token", tags_col: str = "ner", out: str = "entities"
) -> DataFrame:
    """Add the chunks of tagged tokens: `result` is the text, `metadata.entity` the type.

    A chunk begins at a `B-` tag or where an `I-` tag follows another type, and ends before the
    next beginning or untagged token. Beginnings and ends are found as positions and paired, so
    the work is linear in the tokens of a document.
    """
    size = F.size(tags_col)
    positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))

    def tag(i):
        return F.get(tags_col, i)

    def kind(i):
        return F.substr(tag(i), F.lit(3))

    def begins(i):
        follows = F.coalesce(kind(i - 1) == kind(i), F.lit(False))
        return (tag(i) != OUTSIDE) & (tag(i).startswith("B-") | ~follows)

    def ends(i):
        after = tag(i + 1)
        return (tag(i) != OUTSIDE) & (after.isNull() | (after == OUTSIDE) | begins(i + 1))

    def chunk(span):
        words = F.slice(tokens_col, span["first"] + 1, span["last"] - span["first"] + 1)
        return F.struct(
            F.array_join(words, " ").alias("result"),
            F.create_map(F.lit("entity"), kind(span["first"])).alias("metadata"),
        )

    spans = F.arrays_zip(
        F.filter(positions, begins).alias("first"), F.filter(positions, ends).alias("last")
    )
    return settle(df, out, F.transform(spans, chunk).cast(CHUNKS))
