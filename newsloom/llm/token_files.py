"""Token ids as binary files: ranks by frequency, byte-aligned, with separate control bytes.

A file (little-endian):

    8 bytes      b"NLTOKEN1"
    blocks       uint32 number of ids, uint32 number of data bytes, control bytes, data bytes
    documents    int64 ids, uint8 flags (1: the id is null), int64 numbers of tokens
    24 bytes     uint64 where the documents begin, uint64 number of documents, b"NLTOKEN1"

Each control byte holds, from its low bits, the lengths less one of four ranks' data bytes. Blocks
follow documents' order and may end inside a document. `ranks.bin` beside the files holds the ids
by rank as uint32: the most frequent id of all files is rank 0. `manifest` is a table of the files.
"""

from __future__ import annotations

import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import ROW, numbered, partitions, saved, ship, text_or_empty
from .vocabulary import encoder

MAGIC = b"NLTOKEN1"
BLOCK = 1 << 20
#: For each control byte, which of the four bytes of its four ranks are present.
_PRESENT = np.array([[b <= (c >> 2 * i & 3) for i in range(4) for b in range(4)] for c in range(256)])


def encode_block(ranks: np.ndarray) -> bytes:
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    longer = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    fours = np.zeros((len(ranks) + 3) // 4 * 4, dtype=np.uint8)
    fours[:len(ranks)] = longer
    control = (fours.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[_PRESENT[control].reshape(-1, 4)[:len(ranks)]]
    return struct.pack("<II", len(ranks), len(data)) + control.tobytes() + data.tobytes()


def decode_block(n: int, control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Ranks of a block: the control bytes look up where its data bytes belong."""
    out = np.zeros((n, 4), dtype=np.uint8)
    out[_PRESENT[control].reshape(-1, 4)[:n]] = data
    return out.view("<u4").ravel()


def _open(path: str):
    """The file system of a path that all workers reach, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_file(path: str, documents: Iterator[tuple[int | None, np.ndarray]], rank_of: np.ndarray) -> tuple[int, int]:
    """Write (id, token ids) in the given order; returns the numbers of documents and ids."""
    system, place = _open(path)
    part = f"{place}.{uuid.uuid4().hex}"
    keys, nulls, sizes = array("q"), array("B"), array("q")
    held, waiting, at = [], 0, len(MAGIC)

    with system.open_output_stream(part) as out:
        out.write(MAGIC)

        def flush(least: int) -> None:
            nonlocal held, waiting, at
            if waiting < least or not waiting:
                return
            ids = np.concatenate(held)
            for start in range(0, len(ids), BLOCK):
                if least > 1 and len(ids) - start < BLOCK:
                    break
                block = encode_block(rank_of[ids[start:start + BLOCK]])
                out.write(block)
                at += len(block)
            kept = ids[len(ids) // BLOCK * BLOCK:] if least > 1 else ids[:0]
            held, waiting = [kept], len(kept)

        for key, ids in documents:
            keys.append(key or 0)
            nulls.append(key is None)
            sizes.append(len(ids))
            held.append(ids)
            waiting += len(ids)
            flush(BLOCK)
        flush(1)
        out.write(keys.tobytes() + nulls.tobytes() + sizes.tobytes())
        out.write(struct.pack("<QQ", at, len(keys)) + MAGIC)
    system.move(part, place)  # complete files only, also when a task runs twice
    return len(keys), sum(sizes)


def read_file(path: str, id_at: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, token ids) of a file's documents, a block at a time."""
    system, place = _open(path)
    with system.open_input_file(place) as file:
        if file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"not a token file: {path}")
        file.seek(file.size() - 24)
        begin, n = struct.unpack("<QQ", file.read(16))
        file.seek(begin)
        keys = np.frombuffer(file.read(8 * n), dtype="<i8")
        nulls = np.frombuffer(file.read(n), dtype=np.uint8)
        sizes = np.frombuffer(file.read(8 * n), dtype="<i8")
        file.seek(len(MAGIC))
        held = np.empty(0, dtype="<u4")
        for key, null, size in zip(keys.tolist(), nulls.tolist(), sizes.tolist()):
            parts = []
            while size > len(held):
                parts.append(held)
                size -= len(held)
                count, data = struct.unpack("<II", file.read(8))
                control = np.frombuffer(file.read((count + 3) // 4), dtype=np.uint8)
                held = id_at[decode_block(count, control, np.frombuffer(file.read(data), dtype=np.uint8))]
            parts.append(held[:size])
            held = held[size:]
            yield (None if null else key), (parts[0] if len(parts) == 1 else np.concatenate(parts))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text, append the end id, and write the ids in ascending order of the
    integer document ids to new files under `path`, a folder that all workers reach by this name.

    A null or empty text is its end id alone. Null ids come first; rows with the same id keep their
    order in the table. Other columns are not read. An empty table makes a manifest without files.
    The texts are encoded once; the ids wait in the shared scratch folder while they are counted.
    """
    spark = docs.sparkSession
    ship(spark)
    end = array("I", [end_id]).tobytes()
    rows = numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer)
        for batch in batches:
            found = [codec.ids(text.as_py()) + end for text in batch.column("text")]
            sizes = pa.array([len(ids) // 4 for ids in found], pa.int64())
            small = pa.array([_squeezed(ids) for ids in found], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column(ROW), sizes, small], ["doc_id", ROW, "n", "ids"]
            )

    ids = saved(rows.mapInArrow(encoded, f"doc_id long, {ROW} long, n long, ids binary"), "token-ids")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                some = np.bincount(_expanded(value.as_py()))
                if len(some) > len(total):
                    total = np.concatenate([total, np.zeros(len(some) - len(total), dtype=np.int64)])
                total[:len(some)] += some
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    # one row per id of the vocabulary, so its size is bounded
    frequency = ids.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    by_rank = frequency.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy("u4")
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, dtype="<u4")
    rank_of[by_rank] = np.arange(len(by_rank))
    system, place = _open(path)
    system.create_dir(place)
    with system.open_output_stream(f"{place}/ranks.bin") as out:
        out.write(by_rank.astype("<u4").tobytes())

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        pairs = (
            (key.as_py(), _expanded(value.as_py()))
            for batch in batches for key, value in zip(batch.column("doc_id"), batch.column("ids"))
        )
        first = next(pairs, None)
        if first is None:
            return

        def all_pairs():
            yield first
            yield from pairs

        name = f"part-{part:08d}.tok"
        n_docs, n_ids = write_file(f"{path}/{name}", all_pairs(), rank_of)
        columns = [pa.array([part], pa.int64()), pa.array([name]), pa.array([n_docs], pa.int64()), pa.array([n_ids], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "name", "n_docs", "n_ids"])

    order = [F.asc_nulls_first("doc_id"), F.asc(ROW)]
    ranged = ids.select("doc_id", ROW, "ids").repartitionByRange(files or partitions(spark), *order)
    manifest = ranged.sortWithinPartitions(*order).mapInArrow(written, "part long, name string, n_docs long, n_ids long")
    manifest.write.parquet(f"{path}/manifest")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, read back from the files: `doc_id`, `start` (ids of all documents
    before it), `n_tokens` and `ids` (little-endian unsigned 32-bit integers)."""
    ship(spark)
    manifest = spark.read.schema("part long, name string, n_docs long, n_ids long").parquet(f"{path}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_at = None
        for batch in batches:
            for row in batch.to_pylist():
                if id_at is None:
                    system, place = _open(path)
                    with system.open_input_file(f"{place}/ranks.bin") as file:
                        id_at = np.frombuffer(file.read(), dtype="<u4")
                start, held, waiting = row["base"], [], 0
                for key, ids in read_file(f"{path}/{row['name']}", id_at):
                    held.append((key, start, len(ids), ids.tobytes()))
                    start += len(ids)
                    waiting += len(ids)
                    if waiting >= BLOCK:
                        yield _documents(held)
                        held, waiting = [], 0
                if held:
                    yield _documents(held)

    # as many tasks as files may need, by number: the rows are small, what they name is not
    tasks = max(1, manifest.count())
    return based.repartition(tasks).mapInArrow(decoded, "doc_id long, start long, n_tokens long, ids binary")


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "start", "n_tokens", "ids"]
    )


def _squeezed(ids: bytes) -> bytes:
    """Ids for the scratch table: as 16-bit numbers where they fit, compressed."""
    import zstandard

    numbers = np.frombuffer(ids, dtype="<u4")
    if numbers.max(initial=0) <= 0xFFFF:
        return b"2" + zstandard.compress(numbers.astype("<u2").tobytes(), 1)
    return b"4" + zstandard.compress(ids, 1)


def _expanded(data: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(data[1:]), dtype=f"<u{data[:1].decode()}").astype("<u4")
