"""The streaming queries. Each takes a stream, its sinks and a checkpoint, and starts.

`every` is the trigger interval; None works through what is available and stops. The operators
are the same as in batch: here they are only wired to sinks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..fixed_values import CLOUD_LIFETIME
from ..operators import (
    enrich_articles, article_lines, extract_entities, flatten_articles, frequency_changes, prepare_gazetteer, topic_trends,
    rank_trend, trending_entities, word_cloud,
)
from ..sinks.batches import fan_out, start, start_lines
from ..sinks.files import merged_table, read_replaced
from .look_back import LIVE_KEYS, live_counts

ARTICLES_EVERY = "3 seconds"
TOPICS_EVERY = "10 seconds"
CLOUD_EVERY = "5 seconds"
TRENDING_EVERY = "15 seconds"

#: What tells the rows of the trend and cloud tables apart, for sinks that merge.
TREND_KEYS = ("topic", "time_window")
CLOUD_KEYS = ("word", "topic", "time_window")


def article_query(articles: DataFrame, sinks, checkpoint: str, every: str | None = ARTICLES_EVERY) -> StreamingQuery:
    """Append enriched articles."""
    return start(articles, sinks, checkpoint, "append", every)


def topic_query(
    articles: DataFrame,
    sinks,
    checkpoint: str,
    every: str | None = TOPICS_EVERY,
    topic_col: str = "topic",
    ts_col: str = "received_date",
    window: str = "1 minutes",
    watermark: str | None = "10 minutes",
) -> StreamingQuery:
    """Topic counts per window. Windows older than the watermark leave the state, and each trigger
    hands over only the windows that changed, for a sink that merges by `TREND_KEYS`. Without a
    watermark every window is kept and handed over at each trigger, for a sink that replaces."""
    trends = topic_trends(articles, topic_col, ts_col, window, watermark=watermark)
    return start(trends, sinks, checkpoint, "complete" if watermark is None else "update", every)


def word_cloud_query(
    articles: DataFrame,
    sinks,
    checkpoint: str,
    every: str | None = CLOUD_EVERY,
    text_col: str = "title",
    topic_col: str = "topic",
    ts_col: str | None = "received_date",
    lifetime: str = CLOUD_LIFETIME,
    watermark: str = "10 minutes",
    tasks: int | None = None,
    **cloud_args,
) -> StreamingQuery:
    """Word counts in windows as long as an entry's lifetime, which leave the state after the
    watermark; each trigger hands over the words that changed, for a sink that merges by `CLOUD_KEYS`
    and drops what has expired. `ts_col=None` keeps all words for ever and hands over the complete
    cloud at each trigger, for a sink that replaces.

    A micro-batch is spread over `tasks` (by default the cores) before its texts are cut into words,
    as a few files or messages are few tasks.
    """
    spread_out = articles.repartition(tasks or articles.sparkSession.sparkContext.defaultParallelism)
    if ts_col is None:
        return start(word_cloud(spread_out, text_col, topic_col, **cloud_args), sinks, checkpoint, "complete", every)
    timed = spread_out.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, watermark)
    timed = timed.withColumn("time_window", F.window(ts_col, lifetime))
    cloud = word_cloud(timed, text_col, topic_col, keep=("time_window",), **cloud_args)
    return start(cloud.withColumn("time_window", F.col("time_window.start")), sinks, checkpoint, "update", every)


def entity_query(
    lines: DataFrame,
    article_sink,
    entity_sink,
    checkpoint: str,
    gazetteer: DataFrame | None = None,
    text_col: str = "value",
    every: str | None = ARTICLES_EVERY,
    as_of=None,
    **ner_args,
) -> StreamingQuery:
    """Articles first, then the entities of the same micro-batch. The gazetteer is made ready once."""
    ready = None if gazetteer is None else prepare_gazetteer(gazetteer)

    def articles(batch: DataFrame, batch_id: int) -> None:
        article_sink(enrich_articles(batch, text_col, ts=as_of), batch_id)

    def entities(batch: DataFrame, batch_id: int) -> None:
        entity_sink(extract_entities(batch, text_col, ready, as_of, **ner_args), batch_id)

    return start(lines, [articles, entities], checkpoint, "append", every)


def trending_query(
    lines: DataFrame,
    recent: Callable[[], DataFrame],
    sink,
    checkpoint: str,
    every: str | None = TRENDING_EVERY,
    as_of: Callable[[DataFrame], object] | None = None,
    **trend_args,
) -> StreamingQuery:
    """Whenever new lines came in, rank the entities of the last minutes anew and replace the
    trend table. `recent` reads the entity table: the look-back is a filter on it, so nothing but
    the source's place is kept between triggers."""

    def rank(batch: DataFrame, batch_id: int) -> None:
        entities = recent()
        trend = trending_entities(entities, as_of(entities) if as_of else None, **trend_args)
        fan_out([sink], keep=True)(trend, batch_id)

    return start(lines, rank, checkpoint, "append", every)


def live_trending_query(
    entities: DataFrame,
    live: str,
    sink,
    checkpoint: str,
    every: str | None = TRENDING_EVERY,
    lookback: str = "10 minutes",
    step: str = "1 seconds",
    **trend_args,
) -> StreamingQuery:
    """Rank the entities of the last minutes from counts held as state, without reading the entity table
    back. The counts that a trigger changed are merged into the table in the folder `live`, which holds
    one row for each entity of the look-back; the top of it replaces the trend table. The time of the
    trend is that of the newest entity; see `live_counts`.
    """
    merge = merged_table(live, LIVE_KEYS, F.col("count") > 0)

    def rank(batch: DataFrame, batch_id: int) -> None:
        merge(batch, batch_id)
        counted = read_replaced(batch.sparkSession, live)
        now = counted.agg(F.max("last_seen")).scalar()
        sink(rank_trend(counted.select(*LIVE_KEYS, "count"), now, lookback, **trend_args), batch_id)

    return start(live_counts(entities, lookback, step), rank, checkpoint, "update", every)


def frequency_query(
    documents: DataFrame, sink, checkpoint: str, every: str | None = TOPICS_EVERY, terms_col: str = "token",
    change_col: str | None = None,
) -> StreamingQuery:
    """Hand over what each micro-batch changes in the document frequencies, for a `batch_table`, which a
    repeated batch does not count twice; `merge_frequencies` of its rows is the table of all documents."""

    def change(batch: DataFrame, batch_id: int) -> None:
        sink(frequency_changes(batch, terms_col, change_col), batch_id)

    return start(documents, change, checkpoint, "append", every)


def message_query(messages: DataFrame, path: str, checkpoint: str, every: str | None = ARTICLES_EVERY) -> StreamingQuery:
    """JSON messages to article lines in a text folder. The progress of each batch holds the number of
    messages and of unreadable ones as the observed metrics of `read`."""
    return start_lines(article_lines(flatten_articles(messages, observe="read")), path, checkpoint, every)
