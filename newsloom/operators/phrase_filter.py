"""A filter of fixed size for the phrases of a gazetteer that is too large to travel to the tasks.

Words are hashed, and a phrase is a rolling hash of its words. All phrases and all their beginnings are set in a
table of bits (a Bloom filter). A token is followed by its neighbours as long as the words so far may be the
beginning of a phrase, so neither the number of phrases nor the length of the longest one sets the work: that
grows with the matches. What the filter lets through is compared with the gazetteer itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: 64-bit words of a filter: at least, at most (32 MB), and the bits that an entry gets up to there.
LEAST_WORDS, MOST_WORDS, BITS_PER_ENTRY = 1 << 10, 1 << 22, 16
#: Entries that the largest filter holds well, at 8 bits for each.
LARGEST = MOST_WORDS * 8
_CHUNK = 1 << 13  # words that travel in one row
_ROLL, _MIX, _END, _HALF = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0xD6E8FEB86659FD93, 32

CANDIDATES = "array<struct<pos:int,n:int>>"


def filter_words(entries: int) -> int:
    """The size of a filter for so many entries, a power of two."""
    wanted = max(1, entries * BITS_PER_ENTRY // 64)
    return min(MOST_WORDS, max(LEAST_WORDS, 1 << (wanted - 1).bit_length()))


def _functions():
    """Hashing and places of bits. Inner functions travel to the workers by value: these need not have this
    package."""
    roll, mix, end, half = (np.uint64(x) for x in (_ROLL, _MIX, _END, _HALF))
    digest = hashlib.blake2b

    def numbered(values):
        """Hashes of words, and which of them are no word."""
        coded = values.dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = np.frombuffer(b"".join(digest(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in words) + bytes(8), np.uint64)
        at = pc.fill_null(coded.indices, len(words)).to_numpy(zero_copy_only=False)
        return known[at], at == len(words)

    def mixed(sums, whole):
        """A beginning's, or a whole phrase's, entry from its rolling hash."""
        keys = (sums ^ end if whole else sums) * mix
        return (keys ^ (keys >> half)) * mix

    def bits(keys, words):
        """For each entry its place in a table of `words`, and its bits there."""
        one = np.uint64(1)
        marks = np.zeros(len(keys), np.uint64)
        for shift in (0, 6, 12):
            marks |= one << ((keys >> np.uint64(shift)) & np.uint64(63))
        return ((keys >> np.uint64(18)) & np.uint64(words - 1)).astype(np.int64), marks

    def extended(sums, more):
        return (sums + more + np.uint64(1)) * roll

    return numbered, mixed, bits, extended


def _build(table: DataFrame, tokens: Column, words: int, phrases: bool) -> np.ndarray:
    """The bits of the phrases in arrays of words, or of all their words alone: one table of bits for a task, joined by
    parts; what comes to the driver is of the filter's size."""
    numbered, mixed, bits, extended = _functions()
    chunk = min(_CHUNK, words)

    def marked(batches):
        held = np.zeros(words, np.uint64)
        for batch in batches:
            lists = batch.column(0)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            hashes, _ = numbered(lists.values.slice(offsets[0], offsets[-1] - offsets[0]).cast(pa.string()))
            at, left = offsets[:-1] - offsets[0], np.diff(offsets)
            if not phrases:
                place, marks = bits(mixed(extended(np.zeros(len(hashes), np.uint64), hashes), False), words)
                np.bitwise_or.at(held, place, marks)
                continue
            at, left = at[left > 0], left[left > 0]
            sums = np.zeros(len(at), np.uint64)
            while len(at):
                sums = extended(sums, hashes[at])
                ending = left == 1
                for some, whole in ((sums[ending], True), (sums[~ending], False)):
                    place, marks = bits(mixed(some, whole), words)
                    np.bitwise_or.at(held, place, marks)
                sums, at, left = sums[~ending], at[~ending] + 1, left[~ending] - 1
        parts = [i for i in range(0, words, chunk) if held[i:i + chunk].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int32()), pa.array([held[i:i + chunk].tobytes() for i in parts], pa.binary())], ["place", "held"]
        )

    def merged(rows: pa.Table) -> pa.Table:
        held = np.zeros(chunk, np.uint64)
        for part in rows.column("held").to_pylist():
            held |= np.frombuffer(part, np.uint64)
        return pa.table({"place": pa.array([rows.column("place")[0].as_py()], pa.int32()), "held": pa.array([held.tobytes()], pa.binary())})

    schema = "place int, held binary"
    parts = table.select(tokens.alias("words")).mapInArrow(marked, schema)
    out = np.zeros(words, np.uint64)
    for row in parts.groupBy("place").applyInArrow(merged, schema).toLocalIterator():
        out[row["place"]:row["place"] + chunk] = np.frombuffer(row["held"], np.uint64)
    return out


def phrase_filter(phrases: DataFrame, entries: int) -> np.ndarray:
    """The filter of a (phrase) table whose words are joined by one blank, with `entries` words in all."""
    return _build(phrases, F.split("phrase", " "), filter_words(entries), True)


def word_filter(df: DataFrame, tokens_col: str) -> np.ndarray:
    """The filter of all words in token arrays. A word that comes again changes nothing, so nothing is grouped."""
    return _build(df, F.coalesce(tokens_col, F.array().cast("array<string>")), MOST_WORDS, False)


def known_words(table: np.ndarray):
    """A function from token arrays to whether all their words may be in a word filter."""
    numbered, mixed, bits, extended = _functions()

    def known(tokens: pa.Array) -> pa.Array:
        offsets = tokens.offsets.to_numpy().astype(np.int64)
        hashes, none = numbered(tokens.values.slice(offsets[0], offsets[-1] - offsets[0]).cast(pa.string()))
        place, marks = bits(mixed(extended(np.zeros(len(hashes), np.uint64), hashes), False), len(table))
        missed = np.cumsum(np.concatenate([[0], none | ((table[place] & marks) != marks)]))
        ends = offsets - offsets[0]
        return pa.array(missed[ends[1:]] == missed[ends[:-1]])

    return known


def candidates(table: np.ndarray):
    """A function from token arrays to the (pos, n) of the runs of words that may be a phrase of the filter."""
    numbered, mixed, bits, extended = _functions()

    def may_be(sums, whole):
        place, marks = bits(mixed(sums, whole), len(table))
        return (table[place] & marks) == marks

    def found(tokens: pa.Array) -> pa.Array:
        offsets = tokens.offsets.to_numpy().astype(np.int64)
        hashes, none = numbered(tokens.values.slice(offsets[0], offsets[-1] - offsets[0]).cast(pa.string()))
        offsets = offsets - offsets[0]
        ends = np.repeat(offsets[1:], np.diff(offsets))
        start = np.flatnonzero(~none)
        sums, depth, starts, sizes = np.zeros(len(start), np.uint64), 0, [], []
        while len(start):
            sums, depth = extended(sums, hashes[start + depth]), depth + 1
            hits = start[may_be(sums, True)]
            starts.append(hits)
            sizes.append(np.full(len(hits), depth, np.int32))
            goes_on = may_be(sums, False) & (start + depth < ends[start])
            start, sums = start[goes_on], sums[goes_on]
            word = ~none[start + depth]
            start, sums = start[word], sums[word]
        start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int32)
        order = np.lexsort((size, start))
        start, size = start[order], size[order]
        first = np.searchsorted(start, offsets)
        pos = start - np.repeat(offsets[:-1], np.diff(first))
        structs = pa.StructArray.from_arrays([pa.array(pos.astype(np.int32)), pa.array(size)], ["pos", "n"])
        missing = tokens.is_null() if tokens.null_count else None
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), structs, mask=missing)

    return found
