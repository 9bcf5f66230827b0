"""Cost-balanced packing of documents into token sequences.

A document's tokens beyond whole sequences form a piece; attending within pieces costs a linear and
a quadratic share of their length. Pieces go, dearest first, to the cheapest sequence that still has
room for them. What fits nowhere whole is cut over the room that is left, so sequences are full.
Packing is done inside each task, in buffers of a fixed number of tokens: nothing is shuffled.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import ship, text_or_empty
from .vocabulary import encoder

PIECE = ("start", "length", "doc_tokens", "sequence_id", "offset")


def cost_of(length, linear: float, quadratic: float):
    """Estimated cost of a piece: work for each token, and attention between its tokens."""
    return linear * length + quadratic * length * length


def balance(lengths: list[int], sequences: int, size: int, linear: float, quadratic: float):
    """Pieces to `sequences` sequences: (piece, start in it, length, sequence, offset) placements, and
    (piece, start, length) of what is left when all sequences are full."""
    order = sorted(range(len(lengths)), key=lambda i: (-cost_of(lengths[i], linear, quadratic), i))
    cost, room = np.zeros(sequences), np.full(sequences, size, dtype=np.int64)
    placed, rest, left = [], [], []

    def put(piece: int, start: int, length: int, sequence: int) -> None:
        placed.append((piece, start, length, sequence, size - int(room[sequence])))
        room[sequence] -= length
        cost[sequence] += cost_of(length, linear, quadratic)

    for piece in order:
        fits = room >= lengths[piece]
        if fits.any():
            put(piece, 0, lengths[piece], int(np.where(fits, cost, np.inf).argmin()))
        else:
            rest.append(piece)
    for piece in rest:
        start = 0
        while start < lengths[piece]:
            if not room.any():
                left.append((piece, start, lengths[piece] - start))
                break
            sequence = int(np.where(room > 0, cost, np.inf).argmin())
            length = min(int(room[sequence]), lengths[piece] - start)
            put(piece, start, length, sequence)
            start += length
    return placed, left


class Packer:
    """Packs the documents of one task; `rows` collects finished pieces."""

    def __init__(self, first_sequence: int, size: int, buffer_tokens: int, linear: float, quadratic: float):
        self.next, self.size, self.limit = first_sequence, size, max(buffer_tokens, size)
        self.linear, self.quadratic = linear, quadratic
        self.rows: list[tuple] = []
        self.held: list[tuple] = []  # (document, start, ids, document's tokens)
        self.tokens = 0

    def add(self, key, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total - total % self.size
        for start in range(0, whole, self.size):
            self._row(key, start, ids[4 * start:4 * (start + self.size)], total, self.next, 0)
            self.next += 1
        if whole < total:
            self.held.append((key, whole, ids[4 * whole:], total))
            self.tokens += total - whole
        if self.tokens >= self.limit:
            self._flush(self.tokens // self.size, self.size)

    def end(self) -> None:
        """Pack what is held. The last tokens, too few for a sequence, fill one of each power of two
        in their number, which needs no padding."""
        self._flush(self.tokens // self.size, self.size)
        while self.tokens:
            self._flush(1, 1 << (self.tokens.bit_length() - 1))

    def _flush(self, sequences: int, size: int) -> None:
        if not sequences:
            return
        lengths = [len(ids) // 4 for _, _, ids, _ in self.held]
        placed, left = balance(lengths, sequences, size, self.linear, self.quadratic)
        for piece, start, length, sequence, offset in placed:
            key, begin, ids, total = self.held[piece]
            self._row(key, begin + start, ids[4 * start:4 * (start + length)], total, self.next + sequence, offset)
        self.next += sequences
        self.held = [
            (self.held[p][0], self.held[p][1] + start, self.held[p][2][4 * start:4 * (start + length)], self.held[p][3])
            for p, start, length in left
        ]
        self.tokens = sum(len(ids) // 4 for _, _, ids, _ in self.held)

    def _row(self, key, start, ids, total, sequence, offset) -> None:
        self.rows.append((key, start, len(ids) // 4, total, sequence, offset, ids))


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    size: int = 2048,
    buffer_tokens: int = 1 << 20,
    linear: float = 1.0,
    quadratic: float = 1 / 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: the document's id, `start` (its document's ids before it), `length`,
    `doc_tokens` (with the end id), `sequence_id`, `offset` (in the sequence) and `ids` (little-endian
    unsigned 32-bit integers).

    `tokenizer` is the path of a tokenizers file on every worker. A null or empty text is its end id
    alone. Repeated rows are packed each; ids may be null or repeat, other columns are not read. An
    empty table gives no rows. Sequences are numbered by task, so they are the same in a rerun of a
    task over the same rows; a sequence holds documents of one task only.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"]] + [T.StructField(c, T.LongType()) for c in PIECE])
    schema = schema.add("ids", T.BinaryType())
    types = [to_arrow_type(field.dataType) for field in schema]
    names = schema.names
    end = array("I", [end_id]).tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 33, size, buffer_tokens, linear, quadratic)

        def out():
            columns = zip(*packer.rows)
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, types)]
            packer.rows = []
            return pa.RecordBatch.from_arrays(arrays, names)

        waiting = 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                ids = codec.ids(text.as_py()) + end
                packer.add(key.as_py(), ids)
                waiting += len(ids)
                if packer.rows and waiting >= 4 * buffer_tokens:
                    yield out()
                    waiting = 0
        packer.end()
        if packer.rows:
            yield out()

    return rows.mapInArrow(packed, schema)
