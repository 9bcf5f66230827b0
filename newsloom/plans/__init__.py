from .batch_trends import run_batch
from .stream_entities import run_entities
from .stream_messages import run_messages
from .stream_topics import run_topics

__all__ = ["run_batch", "run_entities", "run_messages", "run_topics"]
