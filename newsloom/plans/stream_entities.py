"""Headlines to articles, entities and the trending entities of the last minutes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import EntityTagger
from ..streaming import entity_query, trending_query


def run_entities(
    lines: DataFrame,
    sinks: Mapping[str, object],
    recent: Callable[[], DataFrame],
    checkpoints: str,
    gazetteer: DataFrame | None = None,
    now: bool = False,
    tagger: EntityTagger | None = None,
) -> list[StreamingQuery]:
    """Start both queries over one replayable stream of `value` lines.

    Names outside the gazetteer get their types from a learned `tagger`, if there is one.
    `sinks` has the keys `streaming_articles`, `extracted_entities` and `trending_entities`;
    `recent` reads the table of extracted entities back; before the first batch it has to give an
    empty table, as `sinks.HourlyTable.read` does.
    """
    every = {"every": None} if now else {}
    extracted = entity_query(
        lines, sinks["streaming_articles"], sinks["extracted_entities"], f"{checkpoints}/entities", gazetteer, tagger=tagger, **every
    )
    if now:
        extracted.awaitTermination()
    trending = trending_query(lines, recent, sinks["trending_entities"], f"{checkpoints}/trending", **every)
    return [extracted, trending]
