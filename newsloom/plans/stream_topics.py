"""Headlines to articles, topic trends and word cloud."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import enrich_articles
from ..streaming import article_query, topic_query, word_cloud_query


def run_topics(
    lines: DataFrame, sinks: Mapping[str, object], checkpoints: str, now: bool = False, **enrich_args
) -> list[StreamingQuery]:
    """Start the three queries over one replayable stream of `value` lines.

    `sinks` has the keys `streaming_articles`, `trending_topics` and `wordcloud_realtime`; the last two
    merge, by `TREND_KEYS` and `CLOUD_KEYS`, as `sinks.WindowTable` does, whose `keep` lets old windows
    expire. Each query has a checkpoint of its own under
    `checkpoints`. `now` works through what is available.
    """
    articles = enrich_articles(lines, **enrich_args)
    every = {"every": None} if now else {}
    return [
        article_query(articles, sinks["streaming_articles"], f"{checkpoints}/articles", **every),
        topic_query(articles, sinks["trending_topics"], f"{checkpoints}/topics", **every),
        word_cloud_query(articles, sinks["wordcloud_realtime"], f"{checkpoints}/wordcloud", **every),
    ]
