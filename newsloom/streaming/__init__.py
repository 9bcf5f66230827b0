from .look_back import live_counts
from .queries import (
    CLOUD_KEYS, TREND_KEYS, article_query, entity_query, frequency_query, live_trending_query, message_query, topic_query,
    trending_query, word_cloud_query,
)

__all__ = [
    "CLOUD_KEYS", "TREND_KEYS", "article_query", "entity_query", "frequency_query", "live_counts", "live_trending_query",
    "message_query", "topic_query", "trending_query", "word_cloud_query",
]
