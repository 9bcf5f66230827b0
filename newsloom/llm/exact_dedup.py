"""Exact dedup over a cuckoo-filter index of text digests.

Each task folds its own rows first, so a text with very many copies sends one row per task. Then the
digests are dealt over shards, and each shard's index folds what arrives: a digest whose fingerprint
is not in the filter is new; a hit is looked up among the stored keys of its bucket, and only an
equal digest is a copy. The index's table can take further insertions and deletions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import keep_rows, normalized, partitions, saved, ship

SHARD_KEYS = 200_000


class CuckooIndex:
    """Live digests as 16-bit fingerprints in buckets of four, and beside each home bucket the
    stored entries themselves. An insertion that finds no place doubles the filter and refills it
    from the stored entries; a deletion takes out the entry and one copy of its fingerprint."""

    SLOTS, KICKS = 4, 64

    def __init__(self, buckets: int = 256):
        self.count = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1  # a power of two less one
        self.filter = [[] for _ in range(buckets)]
        self.content: dict[int, list[list]] = {}

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little")
        home = int.from_bytes(digest[:8], "little") & self.mask
        return mark, home, self._other(home, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark + 1) * 0x5BD1E995 & self.mask)

    def find(self, digest: bytes) -> list | None:
        """The entry of a live digest: the filter first, then the stored keys of its home bucket."""
        mark, home, other = self._places(digest)
        if mark not in self.filter[home] and mark not in self.filter[other]:
            return None
        return next((entry for entry in self.content.get(home, ()) if entry[0] == digest), None)

    def insert(self, entry: list) -> None:
        """Add an entry, a list that begins with its digest, which is not in the index."""
        self.content.setdefault(self._places(entry[0])[1], []).append(entry)
        self.count += 1
        if not self._mark(entry[0]):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        entry = self.find(digest)
        if entry is None:
            return False
        mark, home, other = self._places(digest)
        self.content[home].remove(entry)
        self.filter[home if mark in self.filter[home] else other].remove(mark)
        self.count -= 1
        return True

    def entries(self) -> Iterator[list]:
        for bucket in self.content.values():
            yield from bucket

    def _mark(self, digest: bytes) -> bool:
        mark, home, other = self._places(digest)
        for bucket in (home, other):
            if len(self.filter[bucket]) < self.SLOTS:
                self.filter[bucket].append(mark)
                return True
        bucket = other
        for kick in range(self.KICKS):
            slots = self.filter[bucket]
            out = kick % self.SLOTS
            slots[out], mark = mark, slots[out]
            bucket = self._other(bucket, mark)
            if len(self.filter[bucket]) < self.SLOTS:
                self.filter[bucket].append(mark)
                return True
        return False

    def _resize(self) -> None:
        kept, buckets = list(self.entries()), 2 * (self.mask + 1)
        while True:
            self._empty(buckets)
            for entry in kept:
                self.content.setdefault(self._places(entry[0])[1], []).append(entry)
            if all(self._mark(entry[0]) for entry in kept):
                return
            buckets *= 2


def _smaller(a, b) -> bool:
    """Whether id a comes before id b; null comes last."""
    return a is not None and (b is None or a < b)


def _folding(id_type, flush: int | None):
    """A function for `mapInArrow` over (digest, first_id, copies) rows that folds equal digests;
    negative copies are deletions, and an entry without copies goes. `flush`: emit and forget at so
    many keys."""
    names = ["digest", "first_id", "copies"]
    types = [pa.binary(), to_arrow_type(id_type), pa.int64()]

    def emit(index: CuckooIndex):
        held = []
        for entry in index.entries():
            held.append(entry)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for digest, first, copies in zip(*(column.to_pylist() for column in batch.columns)):
                entry = index.find(digest)
                if entry is None:
                    if copies > 0:
                        index.insert([digest, first, copies])
                    continue
                entry[2] += copies
                if entry[2] <= 0:
                    index.delete(digest)
                elif copies > 0 and _smaller(first, entry[1]):
                    entry[1] = first
            if flush and index.count >= flush:
                yield from emit(index)
                index = CuckooIndex()
        yield from emit(index)

    return fold


def digest_of(text_col: str = "text") -> Column:
    """SHA-256 of the normalised text, as bytes."""
    return F.unhex(F.sha2(normalized(text_col), 256))


def _schema(id_type) -> T.StructType:
    return T.StructType().add("digest", T.BinaryType()).add("first_id", id_type).add("copies", T.LongType())


def _shards(rows: DataFrame) -> int:
    return max(partitions(rows.sparkSession), -(-rows.count() // SHARD_KEYS))


def build_index(keys: DataFrame) -> DataFrame:
    """(digest, first_id, copies) of each distinct digest of a (doc_id, digest) table."""
    ship(keys.sparkSession)
    kind = keys.schema["doc_id"].dataType
    rows = keys.select("digest", F.col("doc_id").alias("first_id"), F.lit(1).cast("long").alias("copies"))
    local = rows.mapInArrow(_folding(kind, SHARD_KEYS), _schema(kind))
    return local.repartition(_shards(keys), "digest").mapInArrow(_folding(kind, None), _schema(kind))


def update_index(index: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """The index after inserting and then deleting documents, given as (doc_id, digest) tables.

    A digest is live while it has copies; `first_id` is the smallest id inserted since the digest was
    last absent. Deleting what is not in the index changes nothing.
    """
    kind = index.schema["first_id"].dataType
    steps = [index.select("digest", "first_id", "copies", F.lit(0).alias("_step"))]
    if inserted is not None:
        steps.append(build_index(inserted).withColumn("_step", F.lit(1)))
    if deleted is not None:
        steps.append(build_index(deleted).withColumn("copies", -F.col("copies")).withColumn("_step", F.lit(2)))
    rows = steps[0]
    for step in steps[1:]:
        rows = rows.unionByName(step)
    dealt = rows.repartition(_shards(index), "digest").sortWithinPartitions("_step").drop("_step")
    return dealt.mapInArrow(_folding(kind, None), _schema(kind))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same after replacing each run of white space by one space; a
    null text is empty. The smallest id of a group stays, null ids last. Rows that repeat both id and
    text count in `group_size` and share one verdict; `drop_copies` leaves one of them. Other columns
    are not read; an empty table gives no rows.
    """
    keys = saved(docs.select(F.col(id_col).alias("doc_id"), digest_of(text_col).alias("digest")), "digests")
    index = build_index(keys)
    found = keys.join(index.hint("merge"), "digest")
    return found.select(
        "doc_id",
        F.col("first_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("first_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of equal texts the one with the
    smallest id, and one of rows that repeat id and text (see `exact_dedup`)."""
    verdicts = exact_dedup(docs, id_col, text_col).withColumnRenamed("text_sha256", "key")
    return keep_rows(docs, F.sha2(normalized(text_col), 256), verdicts, id_col)
