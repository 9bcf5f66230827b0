"""Token counts of whole texts, with a shortcut for pre-tokens that are one token."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import saved, ship, text_or_empty
from .vocabulary import Encoder, encoder


def as_plain_text(token: str, back: dict[str, str]) -> str:
    """The plain characters that a vocabulary entry stands for, each by its one or two signs in `back`;
    what stands for none shows as a null character."""
    shown, text, i = token.removesuffix("</w>"), "", 0
    while i < len(shown):
        pair = back.get(shown[i:i + 2])
        text += pair or back.get(shown[i], "\0")
        i += 2 if pair else 1
    return text


def prove_whole_tokens(codec: Encoder, tokens: Iterable[str] | None = None) -> list[str]:
    """Of the vocabulary's strings, or of `tokens` among them, those that are a pre-token of plain
    characters and that the library encodes, alone, as one token. Each is proven by encoding it."""
    tokens = codec.whole.get_vocab(with_added_tokens=False) if tokens is None else tokens
    back = {shown: chr(c) for c, shown in codec.alphabet.items()}
    texts = (as_plain_text(token, back) for token in tokens)
    return [text for text in texts if codec.pieces(text) == [text] and len(codec.library(text)) == 1]


def whole_tokens(spark: SparkSession, tokenizer: str) -> DataFrame:
    """The strings of a vocabulary that are one token, in the one column `token`: proven by a job of
    its own, each once, and saved. It has at most a row for each entry of the vocabulary, whatever is
    counted with it, and may be kept for later counts with the same vocabulary."""
    ship(spark)
    vocabulary = encoder(tokenizer).whole.get_vocab(with_added_tokens=False)
    ids = spark.range(max(vocabulary.values(), default=-1) + 1)

    def proven(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer)
        for batch in batches:
            tokens = filter(None, map(codec.model.id_to_token, batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(prove_whole_tokens(codec, tokens), pa.string())], ["token"])

    return saved(ids.mapInArrow(proven, "token string").distinct(), "whole-tokens")


class Counts(dict):
    """Pre-token to its number of tokens: proven ones are there from the start, the rest are merged
    by the library's model once and remembered."""

    def __init__(self, codec: Encoder, proven: Iterable[str] | None = None):
        super().__init__()
        self.codec = codec
        self.proven = dict.fromkeys(prove_whole_tokens(codec) if proven is None else proven, 1)
        self.update(self.proven)

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.codec.memo:
            self.clear()
            self.update(self.proven)
        self[piece] = n = len(self.codec.model.tokenize(piece.translate(self.codec.alphabet)))
        return n

    def of(self, text: str) -> int:
        pieces = self.codec.pieces(text)
        return len(self.codec.library(text)) if pieces is None else sum(map(self.__getitem__, pieces))


_TABLES: dict[tuple[str, str], Counts] = {}


def counts(path: str, key: str, proven: Broadcast) -> Counts:
    """One for each vocabulary, table of proven strings (named by `key`) and worker process."""
    if (path, key) not in _TABLES:
        _TABLES.clear()
        _TABLES[path, key] = Counts(encoder(path), proven.value)
    return _TABLES[path, key]


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text",
    whole: DataFrame | None = None,
) -> DataFrame:
    """One row per row of `docs`: its id, `n_bytes` (UTF-8), `n_tokens` (without added ones) and
    `over_limit`.

    Texts are counted whole. A null text counts as empty: no bytes, no tokens. Repeated rows and ids
    are counted each, other columns are not read, an empty table gives no rows. No rows are shuffled.
    `whole` is a table that `whole_tokens` made for this vocabulary; by default one is made first.
    Its strings, bounded by the vocabulary, are broadcast to the workers, which prove nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    whole = whole_tokens(spark, tokenizer) if whole is None else whole
    proven = spark.sparkContext.broadcast([row.token for row in whole.select("token").collect()])
    key = uuid.uuid4().hex
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    fields = [rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    types = [to_arrow_type(f.dataType) for f in fields]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts(tokenizer, key, proven)
        for batch in batches:
            found = pa.array([table.of(text.as_py()) for text in batch.column(2)], pa.int64())
            columns = [batch.column(0).cast(types[0]), batch.column(1), found]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(counted, T.StructType(fields)).withColumn("over_limit", F.col("n_tokens") > limit)
