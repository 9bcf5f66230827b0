"""Phrases as a trie over word numbers, in flat arrays that travel to the tasks.

All tokens of a batch are numbered in one lookup. Then each token that begins a phrase walks down the
trie while its neighbours follow; the walks of a batch take their steps together. How many phrases there
are, and how long, does not change the plan, and tokens that begin no phrase cost one step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OUTSIDE = "O"


@dataclass
class PhraseTrie:
    """`keys` are (node << 32 | word) in order, `children` the nodes they lead to; `kinds` is the type of
    the phrase that ends at a node, -1 for none; node 0 is the root."""

    words: pa.Array
    keys: np.ndarray
    children: np.ndarray
    kinds: np.ndarray
    types: list[str]


def walker(trie: PhraseTrie):
    """A function from token arrays to IOB tags for the leftmost-longest phrases."""
    words, keys, children, kinds = trie.words, trie.keys, trie.children, trie.kinds
    names = pa.array([OUTSIDE, *(f"{mark}-{one}" for one in trie.types for mark in "BI")])
    index = {}

    # Inner functions travel to the workers by value: these need not have this package.

    def numbered(tokens):
        """Each token's word number, -1 for words of no phrase. The index is made once for a task."""
        if not index:
            index.update((word, i) for i, word in enumerate(words.to_pylist()))
        distinct = tokens.dictionary_encode()
        found = np.array([index.get(word, -1) for word in distinct.dictionary.to_pylist()] + [-1], np.int64)
        return found[pc.fill_null(distinct.indices, -1).to_numpy(zero_copy_only=False)]

    def longest(numbers, ends):
        """For each token the length of the longest phrase that begins there (0 for none) and its type;
        `ends` is where the token's document ends."""
        sizes, found = np.zeros(len(numbers), np.int64), np.full(len(numbers), -1, np.int64)
        start = at = np.flatnonzero(numbers >= 0)
        node, depth = np.zeros(len(at), np.int64), 0
        while len(at):
            key = node << 32 | numbers[at]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            alive = keys[place] == key
            start, node, depth = start[alive], children[place[alive]], depth + 1
            kind = kinds[node]
            sizes[start[kind >= 0]], found[start[kind >= 0]] = depth, kind[kind >= 0]
            at = start + depth
            inside = at < ends[start]
            start, node, at = start[inside], node[inside], at[inside]
            known = numbers[at] >= 0
            start, node, at = start[known], node[known], at[known]
        return sizes, found

    def tags(tokens: pa.Array) -> pa.Array:
        offsets = tokens.offsets.to_numpy().astype(np.int64)
        values = tokens.values.slice(offsets[0], offsets[-1] - offsets[0]).cast(pa.string())
        offsets = offsets - offsets[0]
        sizes, found = longest(numbered(values), np.repeat(offsets[1:], np.diff(offsets)))
        taken, free = [], 0
        hits = np.flatnonzero(sizes)
        for place, size in zip(hits.tolist(), sizes[hits].tolist()):
            if place >= free:  # no phrase reaches over the end of a document
                taken.append(place)
                free = place + size
        begins = np.array(taken, np.int64)
        size, kind = sizes[begins], found[begins]
        codes = np.zeros(len(values), np.int64)
        inner = np.repeat(begins - np.cumsum(size) + size, size) + np.arange(size.sum())
        codes[inner] = np.repeat(2 * kind + 2, size)
        codes[begins] = 2 * kind + 1
        missing = tokens.is_null() if tokens.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names.take(pa.array(codes)), mask=missing)

    return tags


def build_trie(phrases: pa.ChunkedArray, types: pa.ChunkedArray) -> PhraseTrie:
    """A trie of phrases whose words are joined by one blank, each with one type."""
    split = pc.split_pattern(phrases.combine_chunks().cast(pa.string()), " ")
    coded = split.values.dictionary_encode()
    offsets, words = split.offsets.to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64)
    kinds_of = types.combine_chunks().cast(pa.string()).dictionary_encode()
    kind = kinds_of.indices.to_numpy().astype(np.int64)
    keys, children, kinds = [], [], [np.array([-1])]
    row, node, depth, nodes = np.arange(len(split)), np.zeros(len(split), np.int64), 0, 1
    while len(row):
        edges, which = np.unique(node << 32 | words[offsets[row] + depth], return_inverse=True)
        keys.append(edges)
        children.append(nodes + np.arange(len(edges)))
        node, depth = nodes + which, depth + 1
        nodes += len(edges)
        ending = offsets[row + 1] - offsets[row] == depth
        level = np.full(len(edges), -1, np.int64)
        level[which[ending]] = kind[row[ending]]
        kinds.append(level)
        row, node = row[~ending], node[~ending]
    whole = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    return PhraseTrie(coded.dictionary, whole(keys), whole(children), whole(kinds), kinds_of.dictionary.to_pylist())
