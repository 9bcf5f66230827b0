"""Tokens with their places in the text, by rules: prefixes, suffixes, infixes and exceptions.

A text is cut at white space. From each piece signs are taken off at both ends and it is split at signs
inside, unless it is an exception. Begin and end count characters (code points) from 0, the end being the
first one after the token, so that `substring(text, begin + 1, end - begin)` is the token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import settle
from .trie import OUTSIDE

SPANS = "array<struct<token:string,begin:int,end:int>>"
_KNOWN_PIECES = 200_000
_SLICE_BYTES = 1 << 21
_BLOCK_BITS = 6  # a text is cut into blocks of 64 characters


@dataclass(frozen=True)
class TokenRules:
    """Signs to take off and split at, and pieces (in lower case) that stay whole."""

    prefixes: tuple[str, ...] = ("(", "[", "{", "<", '"', "'", "“", "‘", "«", "¿", "¡", "$", "€", "£", "#", "*", "|")
    suffixes: tuple[str, ...] = (
        "...", "…", "'s", "’s", ")", "]", "}", ">", '"', "'", "”", "’", "»", ".", ",", ";", ":", "!", "?", "%", "*", "|", "&", "$", "#",
    )
    infixes: tuple[str, ...] = ("--", "—", "–", "...", "…", "/", "=")
    exceptions: tuple[str, ...] = (
        "u.s.", "u.k.", "e.g.", "i.e.", "etc.", "mr.", "mrs.", "ms.", "dr.", "st.", "vs.", "a.m.", "p.m.", "z.b.", "d.h.", "m.", "mme.",
    )


def _cutter(rules: TokenRules):
    """A function from a piece without white space to the (begin, end) of its tokens. Inner functions
    travel to the workers by value: these need not have this package."""
    either = lambda signs: "|".join(re.escape(s) for s in sorted(signs, key=len, reverse=True)) or r"(?!)"
    prefix, inside = re.compile(either(rules.prefixes)), re.compile(either(rules.infixes))
    suffix = re.compile(rf"(?:{either(rules.suffixes)})\Z", re.IGNORECASE)
    whole = frozenset(rules.exceptions)

    def cut(piece):
        begin, end, before, after = 0, len(piece), [], []
        while begin < end and piece[begin:end].lower() not in whole:
            found = prefix.match(piece, begin, end)
            if found:
                before.append((begin, found.end()))
                begin = found.end()
                continue
            found = suffix.search(piece[begin:end])
            if not found:
                break
            after.append((begin + found.start(), end))
            end = begin + found.start()
        at = begin
        if piece[begin:end].lower() not in whole:
            for found in inside.finditer(piece, begin, end):
                if found.start() > at:
                    before.append((at, found.start()))
                before.append(found.span())
                at = found.end()
        if at < end:
            before.append((at, end))
        return before + after[::-1]

    return cut


def _byte_work():
    """Functions on the bytes of texts, which travel to the workers by value. A batch is worked on, and handed back, in
    slices of a few MB, so that what is held does not grow with it."""
    most = _SLICE_BYTES

    def plain(texts):
        return texts.cast(pa.string()).fill_null("")

    def slices(texts):
        """The (first, end) rows of slices of about as many bytes each."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        cuts = np.flatnonzero(np.diff((offsets[:-1] - offsets[0]) // most)) + 1 if len(texts) else []
        edges = [0, *cuts, len(texts)]
        return list(zip(edges, edges[1:]))

    def content(texts):
        """The bytes of texts, and where each of them begins."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        held = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        return held, offsets - offsets[0]

    def strings(held, begins, ends):
        """The parts of bytes between places."""
        sizes = ends - begins
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        parts = held[np.repeat(begins - offsets[:-1], sizes) + np.arange(offsets[-1])]
        return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(parts))

    return plain, slices, content, strings


def token_spans(df: DataFrame, text_col: str = "text", out: str = "spans", rules: TokenRules = TokenRules()) -> DataFrame:
    """Add the tokens of a text with their places; none for an empty text, null for a null one. All
    characters but white space are in exactly one token."""
    cut, most, known = _cutter(rules), _KNOWN_PIECES, {}
    plain, slices, content, strings = _byte_work()
    blank = np.zeros(256, bool)
    blank[list(b" \t\n\r\f\v")] = True

    def cuts_of(piece):
        """(begin, end) of a piece's tokens in characters and in bytes."""
        found = known.get(piece)
        if found is None:
            if len(known) >= most:
                known.clear()
            found = cut(piece)
            byte = (lambda i: i) if piece.isascii() else (lambda i: len(piece[:i].encode()))
            found = known[piece] = [(begin, end, byte(begin), byte(end)) for begin, end in found]
        return found

    def cut_up(texts):
        """The tokens of a slice, their begins and ends, and their number in each text."""
        held, rows = content(texts)
        inside = ~blank[held]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = rows[(rows > 0) & (rows < len(held))]  # a text's first byte begins a piece, its last one ends it
        first[edges], last[edges - 1] = inside[edges], inside[edges - 1]
        starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        chars = np.concatenate([[0], np.cumsum((held & 0xC0) != 0x80)])
        row = np.searchsorted(rows, starts, "right") - 1
        coded = strings(held, starts, stops).dictionary_encode()
        cuts = [cuts_of(piece) for piece in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        flat = np.fromiter((x for found in cuts for one in found for x in one), np.int64).reshape(-1, 4)
        at = coded.indices.to_numpy().astype(np.int64)
        size = sizes[at]
        ahead = np.cumsum(size) - size
        which = np.repeat((np.cumsum(sizes) - sizes)[at] - ahead, size) + np.arange(size.sum())
        places = np.repeat(chars[starts] - chars[rows[row]], size)
        start = np.repeat(starts, size)
        tokens = strings(held, start + flat[which, 2], start + flat[which, 3])
        begins, ends = ((places + flat[which, k]).astype(np.int32) for k in (0, 1))
        return pa.StructArray.from_arrays([tokens, pa.array(begins), pa.array(ends)], ["token", "begin", "end"]), \
            np.bincount(row, size, len(texts)).astype(np.int64)

    @F.arrow_udf(SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for first, end in slices(texts):
                some = texts.slice(first, end - first)
                found, counts = cut_up(plain(some))
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.ListArray.from_arrays(offsets, found, mask=pc.is_null(some) if some.null_count else None)

    return settle(df.withColumn(out, spans(F.col(text_col))), out, F.col(out))


def chunk_spans(df: DataFrame, spans_col: str = "spans", tags_col: str = "ner", out: str = "chunks", text_col: str = "text") -> DataFrame:
    """IOB tags of spans to chunks: (result, entity, begin, end), the result being the text between the begin
    of the first token and the end of the last. A chunk begins at `B-`, or at `I-` of a type that the tag
    before does not have, as in `iob_to_chunks`."""

    def tag(i) -> Column:
        return F.coalesce(F.when(i >= 0, F.get(tags_col, i)), F.lit(OUTSIDE))

    def begins(i) -> Column:
        here, before = tag(i), tag(i - 1)
        other = (before == OUTSIDE) | (F.substr(before, F.lit(3)) != F.substr(here, F.lit(3)))
        return (here != OUTSIDE) & (here.startswith("B-") | other)

    places = F.transform(tags_col, lambda _, i: i)
    first = settle(df, "_first", F.filter(places, begins))
    last = settle(first, "_last", F.filter(places, lambda i: (tag(i) != OUTSIDE) & ((tag(i + 1) == OUTSIDE) | begins(i + 1))))

    begins_at = F.transform("_first", lambda i: F.get(spans_col, i)["begin"])
    ends_at = F.transform("_last", lambda i: F.get(spans_col, i)["end"])
    cut = texts_at(settle(settle(last, "_begins", begins_at), "_ends", ends_at), text_col, "_begins", "_ends", "_results")

    def chunk(i, k) -> Column:
        return F.struct(
            F.get("_results", k).alias("result"), F.substr(tag(i), F.lit(3)).alias("entity"),
            F.get("_begins", k).alias("begin"), F.get("_ends", k).alias("end"),
        )

    return settle(cut, out, F.transform("_first", chunk)).drop("_first", "_last", "_begins", "_ends", "_results")


def texts_at(df: DataFrame, text_col: str, begins_col: str, ends_col: str, out: str) -> DataFrame:
    """Add the parts of a text between two arrays of places, in characters; places count as in Python's slices. The text
    is cut into blocks once, and a part is taken from the blocks that it touches, so the work grows with the parts
    and the text, not with their product. Rows stay where they are: their other columns may be much larger."""
    whole = F.col(text_col).isNotNull() & F.col(begins_col).isNotNull() & F.col(ends_col).isNotNull()
    cut = settle(df, "_blocks", F.regexp_extract_all(text_col, F.lit(f"(?s).{{1,{1 << _BLOCK_BITS}}}"), F.lit(0)))
    cut = settle(cut, "_length", F.length(text_col))
    length = F.col("_length")

    def place(at: Column, none: Column) -> Column:
        at = F.coalesce(at, none)
        return F.least(F.when(at < 0, F.greatest(at + length, F.lit(0))).otherwise(at), length)

    def part(span: Column) -> Column:
        first, last = F.shiftright(span["begin"], _BLOCK_BITS), F.shiftright(span["end"] - 1, _BLOCK_BITS)
        over = F.array_join(F.slice("_blocks", first + 1, last - first + 1), "")
        held = F.when(first == last, F.get("_blocks", first)).otherwise(over)
        there = F.substring(held, span["begin"] - F.shiftleft(first, _BLOCK_BITS) + 1, span["end"] - span["begin"])
        return F.when(span["end"] > span["begin"], there).otherwise("")

    both = F.slice(begins_col, F.lit(1), F.least(F.size(begins_col), F.size(ends_col)))
    spans = F.transform(both, lambda begin, i: F.struct(
        place(begin, F.lit(0)).alias("begin"), place(F.get(ends_col, i), length).alias("end")))
    cut = settle(cut, "_spans_at", F.when(whole, spans))
    return settle(cut, out, F.transform("_spans_at", part)).drop("_blocks", "_length", "_spans_at")
