"""Cross-tokenizer alignment: where two tokenizers cut the same text, and which of their tokens share bytes.

Both libraries say where each token lies: characters for the byte-level one, bytes for the piece model.
These spans are coarse cuts. Tokens that end inside a character (byte-level tokens of a multibyte
character, byte-fallback pieces) are cut finer by the bytes that they decode to.

A single space between two other characters begins a new token in both tokenizers, so a text is the
row of its chunks between such spaces, and each distinct chunk is aligned once for each worker. How many
documents hold a pair of ids linked is counted by blocks of documents: a block brings each of its pairs
once to the counts, and gets them back as one list.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import saved, ship, text_or_empty

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

#: A single space that begins a token in both tokenizers: not beside white space, nor beside the sign that the
#: piece model reads as a space.
_SEAM = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
_WHOLE = re.compile(r"[^\s▁](.*[^\s▁])?\Z", re.DOTALL)
MEMO = 600_000  # chunks remembered by a worker
MEMO_CHARS = 64  # longer chunks are not remembered
BLOCK_CHARS = 4 << 20  # text of the documents of a block, unless one alone is longer

NOTHING = (0, 0, 0, 0, "", b"")


def byte_level_table() -> dict[str, int]:
    """The byte that each character of the byte-level alphabet stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokens:
    """Tokens of a text: ids, the byte where each ends, and whether their bytes are the text's."""

    def __init__(self, ids: list[int], cuts: np.ndarray, spellings: list[bytes], data: bytes, fine):
        """`cuts` are the library's ends, `fine` says which tokens may end before or after theirs: those
        of a character that several share. Their ends come from the bytes that they stand for."""
        self.ids = np.array(ids, np.int64)
        own = [spellings[i] for i in ids]
        self.ends = np.cumsum([len(one) for one in own], dtype=np.int64)
        gap = cuts - self.ends
        self.faithful = b"".join(own) == data and bool(((gap == 0) | fine(self.ids, gap)).all())


class Aligner(dict):
    """Chunk to (n_a, n_b, n_groups, groups, pairs); None where a tokenizer does not give the chunk's
    bytes back. `pairs` are the linked (a << 32 | b), as bytes, one for each link."""

    def __init__(self, byte_level: str, piece_model: str, memo: int = MEMO):
        import sentencepiece
        from tokenizers import Tokenizer

        super().__init__()
        self.memo = memo
        self.again: set[str] = set()  # remembered chunks that came again since room was made
        self.first = Tokenizer.from_file(byte_level)
        self.first.encode_special_tokens = True  # their strings in a text are ordinary text
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        table = byte_level_table()
        added = {token["id"] for token in json.load(open(byte_level, encoding="utf-8"))["added_tokens"]}
        size = self.first.get_vocab_size(with_added_tokens=True)
        self.first_bytes = [
            b"" if i in added else bytes(table[c] for c in self.first.id_to_token(i) or "") for i in range(size)
        ]
        pieces = [self.second.id_to_piece(i) for i in range(self.second.vocab_size())]
        self.single = np.array([self.second.is_byte(i) for i in range(len(pieces))])
        self.second_bytes = [
            bytes([int(piece[1:-1], 16)]) if single else piece.replace("▁", " ").encode()
            for piece, single in zip(pieces, self.single)
        ]
        # a piece with a space after another character would join two chunks
        self.by_chunks = not any(re.search("[^▁]▁", piece) for piece in pieces)
        # how an id is written before the next one, and at the end of its side of a group
        self.shown = [np.array([[f"{i}{mark}" for i in range(n)] for mark in marks], object) for n, marks in ((size, ",|"), (len(pieces), ",;"))]

    def first_tokens(self, text: str, data: bytes) -> Tokens:
        """Tokens of space+text by the library's character ends, refined inside multibyte characters."""
        (found,) = self.first.encode_batch([f" {text}"], add_special_tokens=False)
        cuts = np.array([end for _, end in found.offsets], np.int64)
        if len(data) > len(text) + 1:
            code = np.frombuffer(f" {text}".encode("utf-32-le"), np.uint32)
            width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
            cuts = np.concatenate([[0], np.cumsum(width)])[cuts]
        return Tokens(found.ids, cuts, self.first_bytes, data, lambda _, gap: (gap > 0) & (gap < 4))

    def second_tokens(self, text: str, data: bytes) -> Tokens:
        """The same by the piece model, which adds the space and tells spans in bytes without it. Pieces
        in byte fallback share their character's span: only the last one ends where it does."""
        pieces = self.second.encode(text, return_type="proto").pieces
        cuts = np.array([piece.end for piece in pieces], np.int64) + 1
        return Tokens([piece.id for piece in pieces], cuts, self.second_bytes, data, lambda ids, gap: self.single[ids] & (gap < 0) & (gap > -4))

    def aligned(self, chunks: list[str]) -> list[tuple | None]:
        """Align the chunks of a text; if they do not all come back byte by byte, each half alone."""
        text = " ".join(chunks)
        data = f" {text}".encode()
        a, b = self.first_tokens(text, data), self.second_tokens(text, data)
        if not (a.faithful and b.faithful):
            half = len(chunks) // 2
            return self.aligned(chunks[:half]) + self.aligned(chunks[half:]) if half else [None]
        ends_a, ends_b = (np.bincount(one.ends, minlength=len(data) + 1) > 0 for one in (a, b))
        cuts = np.flatnonzero(ends_a | ends_b)  # a link is a run of bytes between two cuts
        pairs = a.ids[np.searchsorted(a.ends, cuts)] << 32 | b.ids[np.searchsorted(b.ends, cuts)]
        shared = np.flatnonzero(ends_a & ends_b)  # a group ends where both do
        group_a, group_b = np.searchsorted(shared, a.ends), np.searchsorted(shared, b.ends)
        last_a, last_b = ((shared[group] == one.ends).astype(np.int64) for group, one in ((group_a, a), (group_b, b)))
        marks = np.empty(len(a.ids) + len(b.ids), object)
        marks[np.arange(len(a.ids)) + np.searchsorted(group_b, group_a)] = self.shown[0][last_a, a.ids]
        marks[np.arange(len(b.ids)) + np.searchsorted(group_a, group_b, "right")] = self.shown[1][last_b, b.ids]
        stops = np.cumsum([len(chunk.encode()) + 1 for chunk in chunks])
        ends = (np.searchsorted(x, stops, "right").tolist() for x in (a.ends, b.ends, shared, cuts))
        raw, marks = pairs.tobytes(), marks.tolist()
        out, at = [], (0, 0, 0, 0)
        for now in zip(*ends):
            groups = "".join(marks[at[0] + at[1]:now[0] + now[1]])[:-1]
            out.append((now[0] - at[0], now[1] - at[1], now[2] - at[2], groups, raw[8 * at[3]:8 * now[3]]))
            at = now
        return out

    def learn(self, chunks: list[str]) -> None:
        """Align chunks and remember them, those without white space at an end as one text."""
        together = [chunk for chunk in chunks if _WHOLE.match(chunk)]
        for start in range(0, len(together), 4096):
            part = together[start:start + 4096]
            self.update(zip(part, self.aligned(part)))
        if len(together) < len(chunks):
            self.update((chunk, self.aligned([chunk])[0]) for chunk in chunks if chunk not in self)

    def make_room(self) -> None:
        """Forget what did not come again since the last time, as most chunks of a corpus come once, and
        of a memo that is still nearly full the newest."""
        kept = [(chunk, value) for chunk, value in self.items() if chunk in self.again]
        self.clear()
        self.update(islice(kept, 3 * self.memo // 4))
        self.again.clear()

    def texts(self, texts: list[str]) -> list[tuple]:
        """Alignments (n_a, n_b, n_groups, n_links, groups, pairs) of whole texts; a text without a
        faithful one, or an empty one, has nothing."""
        split = [(_SEAM.split(text) if self.by_chunks else [text]) if text else [] for text in texts]
        chunks = set().union(*split)
        missing = [chunk for chunk in chunks if chunk not in self]
        self.again.update(chunks.difference(missing))
        self.learn(missing)
        broken = {chunk for chunk in chunks if self[chunk] is None}
        whole = []
        for text, own in zip(texts, split):
            if not own:
                whole.append(NOTHING)
            elif broken and not broken.isdisjoint(own):  # only the library can tell whether the whole text comes back
                whole.append(_counted([self.aligned([text])[0]]))
            else:
                whole.append(_counted(list(map(self.__getitem__, own))))
        for chunk in missing:
            if len(chunk) > MEMO_CHARS:
                del self[chunk]
        if len(self) > self.memo:
            self.make_room()
        return whole


def _counted(parts: list[tuple | None]) -> tuple:
    """The alignment of a text from those of its chunks."""
    if parts == [None]:
        return NOTHING
    n_a, n_b, n_groups, groups, pairs = zip(*parts)
    pairs = b"".join(pairs)
    return sum(n_a), sum(n_b), sum(n_groups), len(pairs) // 8, ";".join(groups), pairs


@lru_cache(maxsize=2)
def aligner(byte_level: str, piece_model: str) -> Aligner:
    """One for each pair of vocabularies and worker process."""
    return Aligner(byte_level, piece_model)


class _Block:
    """Documents whose pairs are counted together."""

    def __init__(self):
        self.ids, self.counts, self.groups, self.pairs, self.times, self.chars = [], [], [], [], [], 0

    def add(self, doc_id, chars: int, found: tuple) -> None:
        pairs, times = np.unique(np.frombuffer(found[5], np.int64), return_counts=True)
        self.ids.append(doc_id)
        self.counts.append(found[:4])
        self.groups.append(found[4])
        self.pairs.append(pairs)
        self.times.append(times.astype(np.uint32))
        self.chars += chars + 1

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        sizes = np.array([len(pairs) for pairs in self.pairs], np.int32)
        pairs, places, held = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        steps = np.diff(places.astype(np.int32), prepend=np.int32(0))
        n = np.array(self.counts, np.int64)
        docs = pa.StructArray.from_arrays(
            [pa.array(self.ids, id_type), *(pa.array(n[:, i]) for i in range(4)), pa.array(self.groups, pa.string())],
            [*_DOC],
        )
        columns = [
            pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs, pa.int64())),
            pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(held.astype(np.int32))),
            *(pa.array([_packed(x)], pa.binary()) for x in (sizes, steps, np.concatenate(self.times))),
        ]
        return pa.RecordBatch.from_arrays(columns, [*_BLOCK])


_DOC = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
_BLOCK = ("docs", "pairs", "held", "sizes", "steps", "times")


def _packed(numbers: np.ndarray) -> bytes:
    return len(numbers).to_bytes(8, "little") + pa.compress(numbers.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, kind) -> np.ndarray:
    n, kind = int.from_bytes(data[:8], "little"), np.dtype(kind)
    return np.frombuffer(pa.decompress(data[8:], n * kind.itemsize, codec="zstd", asbytes=True), kind)


def aligned_blocks(
    docs: DataFrame, byte_level: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Align whole texts. One row per block of documents of about `block_chars` characters:

    * `docs`: (doc_id, n_a, n_b, n_groups, n_links, groups) of each row of the table, groups being
      `a1,a2|b1;a3|b2,b3`: the ids of both tokenizers between two cuts that they share;
    * `pairs`, `held`: the linked (a << 32 | b) in the block and how many of its documents hold each;
    * packed numbers that say which pairs a document holds, and how often.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    long = T.LongType()
    doc = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType)]
                       + [T.StructField(name, long) for name in _DOC[1:5]] + [T.StructField("groups", T.StringType())])
    schema = T.StructType([
        T.StructField("docs", T.ArrayType(doc)), T.StructField("pairs", T.ArrayType(long)),
        T.StructField("held", T.ArrayType(T.IntegerType())),
        *(T.StructField(name, T.BinaryType()) for name in _BLOCK[3:]),
    ])
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, block = aligner(byte_level, piece_model), _Block()
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = part.column(1).to_pylist()
                for doc_id, text, found in zip(part.column(0).to_pylist(), texts, tool.texts(texts)):
                    if block.ids and block.chars + len(text) > block_chars:
                        yield block.batch(id_type)
                        block = _Block()
                    block.add(doc_id, len(text), found)
        if block.ids:
            yield block.batch(id_type)

    return rows.mapInArrow(blocks, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents a pair of ids is linked, and whether no other pair
    of the same first id is in more."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("one"))
    counts = held.groupBy(F.col("one.pairs").alias("pair")).agg(F.sum("one.held").alias("count"))
    counts = saved(counts, "pair-counts")
    first = F.shiftright("pair", 32)
    # one row per id of the first vocabulary: its size bounds what is broadcast, whatever the corpus
    most = counts.groupBy(first.alias("first")).agg(F.max("count").alias("most"))
    marked = counts.withColumn("first", first).join(F.broadcast(most), "first")
    return marked.select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def align(
    docs: DataFrame, byte_level: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text",
    shown: Callable[[Column], Column] = lambda groups: groups, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per row of `docs`: doc_id, tokens of both tokenizers (`n_a`, `n_b`), `n_groups`,
    `n_links`, `n_best` (links whose pair is in as many documents as any of their first id's),
    `count_sum` (the documents of all links' pairs, added up) and `groups`.

    `byte_level` is a byte-level vocabulary of the tokenizers library, which gets a space before the
    text; `piece_model` a sentencepiece model that adds one itself. `shown` is applied to the groups
    before anything is written, so a caller that wants their digest does not store them.

    Texts are aligned whole. A null or empty text, or one that a tokenizer does not give back byte by
    byte, has no tokens: zeros and empty groups. Repeated rows count each as a document; ids may be
    null; other columns are not read; an empty table gives no rows. Pairs are counted over all
    documents. What is shuffled are each block's distinct pairs, once for the counts and once to
    bring these back, so that neither a frequent pair nor a large document lands in one task.
    """
    made = aligned_blocks(docs, byte_level, piece_model, id_col, text_col, block_chars)
    doc = lambda d: F.struct(*(d[name].alias(name) for name in _DOC[:-1]), shown(d["groups"]).alias("groups"))
    made = made.withColumn("docs", F.transform("docs", doc)).withColumn("block", F.monotonically_increasing_id())
    blocks = saved(made, "aligned")
    held = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    known = held.join(pair_counts(blocks).hint("merge"), "pair")
    code = F.col("count") * 2 + F.col("best").cast("long")
    lists = known.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("place", code.alias("code")))).alias("codes"))
    lists = lists.select("block", F.col("codes.code").alias("codes"))
    out = T.StructType([
        T.StructField("doc_id", docs.schema[id_col].dataType), *(T.StructField(n, T.LongType()) for n in _DOC[1:5]),
        T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
        T.StructField("groups", made.schema["docs"].dataType.elementType["groups"].dataType),
    ])
    types = [to_arrow_type(field.dataType) for field in out]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row] for name in ("docs", "codes", "sizes", "steps", "times")}
                rows = one["docs"].values
                codes = np.zeros(0, np.int64) if not one["codes"].is_valid else one["codes"].values.to_numpy()
                sizes, steps, times = (_unpacked(one[n].as_py(), t) for n, t in (("sizes", "i4"), ("steps", "i4"), ("times", "u4")))
                code = codes[np.cumsum(steps, dtype=np.int64)]
                ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
                best, summed = (np.concatenate([[0], np.cumsum(x)]) for x in (times * (code & 1), times * (code >> 1)))
                columns = dict(zip(_DOC, rows.flatten()))
                columns |= {"n_best": pa.array(np.diff(best[ends])), "count_sum": pa.array(np.diff(summed[ends]))}
                yield pa.RecordBatch.from_arrays([columns[n].cast(t) for n, t in zip(out.names, types)], out.names)

    both = blocks.join(lists.hint("merge"), "block", "left").select("docs", "codes", "sizes", "steps", "times")
    return both.mapInArrow(scored, out)
