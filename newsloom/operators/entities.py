"""Entity extraction, counts and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..fixed_values import ARTICLE_SOURCE, ENTITY_CONFIDENCE
from ..functions import moment
from .chunks import iob_to_chunks
from .tagger import EntityTagger, tag_entities
from .tokens import assemble, tokenize


def annotate_entities(
    df: DataFrame, text_col: str, gazetteer: DataFrame | None = None, id_col: str | None = "doc_id",
    tagger: EntityTagger | None = None, **ner_args,
) -> DataFrame:
    """Text to (id, text, token, ner, entities). Capitalised words outside the gazetteer have the type
    a learned `tagger` finds, or one type for all without it."""
    return iob_to_chunks(tag_entities(tokenize(assemble(df, text_col, id_col)), gazetteer, tagger, **ner_args))


def entity_pairs(annotated: DataFrame, entities_col: str = "entities", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row (entity, entity_type) per chunk."""
    chunks = annotated.select(*keep, F.explode(entities_col).alias("_chunk"))
    return chunks.select(
        *keep, F.col("_chunk.result").alias("entity"), F.col("_chunk.metadata").getItem("entity").alias("entity_type")
    )


def extract_entities(
    df: DataFrame,
    text_col: str,
    gazetteer: DataFrame | None = None,
    as_of=None,
    source: str = ARTICLE_SOURCE,
    **ner_args,
) -> DataFrame:
    """Entity rows of a batch or stream of texts, names of one character left out."""
    pairs = entity_pairs(annotate_entities(df, text_col, gazetteer, None, **ner_args))
    return pairs.where(F.col("entity").isNotNull() & (F.length("entity") > 1)).select(
        F.col("entity").alias("entity_name"),
        "entity_type",
        moment(as_of).alias("detected_at"),
        F.lit(source).alias("source"),
        F.lit(ENTITY_CONFIDENCE).alias("confidence"),
        F.lit(1).alias("frequency"),
    )


def _ranked(counted: DataFrame, keys: list[str], k: int | None) -> DataFrame:
    ordered = counted.orderBy(F.desc("count"), *keys)
    return ordered if k is None else ordered.limit(k)


def entity_counts(annotated: DataFrame, k: int | None = 10, entities_col: str = "entities") -> DataFrame:
    """The most frequent entities; all of them with `k=None`."""
    entities = annotated.select(F.explode(f"{entities_col}.result").alias("entity"))
    return _ranked(entities.groupBy("entity").count(), ["entity"], k)


def entity_type_counts(annotated: DataFrame, date=None, entities_col: str = "entities") -> DataFrame:
    """How often each (entity, type) occurs, with the date of the count."""
    recorded = F.current_date() if date is None else F.lit(date).cast("date")
    counted = entity_pairs(annotated, entities_col).groupBy("entity", "entity_type").count()
    return _ranked(counted, ["entity", "entity_type"], None).withColumn("date_recorded", recorded)


def trending_entities(
    entities: DataFrame,
    as_of=None,
    lookback: str = "10 minutes",
    k: int = 20,
    factor: float = 1.5,
    source: str = ARTICLE_SOURCE,
) -> DataFrame:
    """The top entities among those detected within `lookback` before `as_of`."""
    now = moment(as_of)
    recent = entities.where(F.col("detected_at") >= now - F.expr(f"interval {lookback}"))
    return rank_trend(recent.groupBy("entity_name", "entity_type").count(), now, lookback, k, factor, source)


def rank_trend(
    counted: DataFrame,
    now,
    lookback: str = "10 minutes",
    k: int = 20,
    factor: float = 1.5,
    source: str = ARTICLE_SOURCE,
) -> DataFrame:
    """The top entities of a table of counts over the `lookback` before `now`, a column."""
    top = _ranked(counted, ["entity_name", "entity_type"], k)
    return top.select(
        "entity_name",
        "entity_type",
        "count",
        (F.col("count") * factor).alias("trend_score"),
        now.alias("time_window"),
        F.lit(lookback).alias("window_duration"),
        F.lit(source).alias("source"),
    )
