from .files import in_memory, load_lexicon, read_corpus, read_wordlist
from .jdbc import read_jdbc
from .streams import kafka_messages, line_stream, message_stream

__all__ = [
    "in_memory", "kafka_messages", "line_stream", "load_lexicon", "message_stream", "read_corpus",
    "read_jdbc", "read_wordlist",
]
