"""Near-dedup by DartMinHash signatures in bands.

Every shingle's region is a quadrant of weight and rank. Darts fall on it at the points of a hashed
Poisson process: one stream of ranks for each unit of weight, so a shingle of weight 3 owns three
streams. A document takes the darts below a rank that makes about k ln k + 2k of them, whatever its
length, each dart hashes to one of k coordinates, and the earliest dart of a coordinate is its
minimum. Two documents agree in a coordinate with the probability of their weighted Jaccard
similarity. A coordinate that no dart met makes the document throw again, twice as far; earlier
minima stay, as the streams are the same.

Documents that agree in a band are candidates: links if the texts' word shingles agree to the
threshold. A bucket is a star around its smallest member first, which joins most copies. In buckets
that still hold several components, all other pairs of different components are then compared, in
blocks of bounded size so that no task holds a large bucket. Within two blocks a prefix filter, which
no link escapes, says which pairs to compare, and pairs that links of these blocks have joined
meanwhile are left out. So the classes are those of all links between documents that share a band.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.lexicon import even_join
from .common import keep_rows, listed, normalized, saved, ship, text_or_empty
from .components import components

#: Shingles of a text that takes one place in a block; longer texts fill more.
BLOCK_SHINGLES = 1_000

_U = np.uint64
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over an array."""
    x = x ^ (x >> _U(30))
    x = x * _MIX[0]
    x = x ^ (x >> _U(27))
    x = x * _MIX[1]
    return x ^ (x >> _U(31))


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Hashes of all runs of so many words of the whole text, in order and with repeats; none for a
    shorter text."""
    import xxhash

    parts = text.encode().split()
    if len(parts) < words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, parts), dtype=np.uint64, count=len(parts))
    n = len(parts) - words + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(words):
        out = out * _U(0x9E3779B97F4A7C15) + hashes[i:i + n]
    return _mixed(out)


def signature(cells: np.ndarray, k: int) -> np.ndarray:
    """k coordinates for a set of units of weight, each given by its hash: the name of the earliest
    dart of each coordinate. Empty for an empty set."""
    if not len(cells):
        return np.empty(0, dtype=np.uint64)
    reach = (k * log(k) + 2 * k) / len(cells)
    while True:
        rank, drawn = _darts(cells, reach)
        name = _mixed(drawn ^ _U(0xA0761D6478BD642F))
        order = np.argsort(-rank, kind="stable")
        place = ((name >> _U(32)) % _U(k)).astype(np.int64)[order]
        mark, met = np.zeros(k, dtype=np.uint64), np.zeros(k, dtype=bool)
        mark[place] = name[order]  # the earliest comes last and stays
        met[place] = True
        if met.all():
            return mark
        reach *= 2


def _darts(cells: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Rank and hash of all darts up to the reach: each unit's stream has exponential gaps."""
    at_once = 1 if reach < 0.5 else int(reach + 3 * reach ** 0.5 + 3)
    ranks, hashes = [], []
    rank, thrown = np.zeros(len(cells)), 0
    while len(cells):
        index = np.arange(thrown + 1, thrown + at_once + 1, dtype=np.uint64) * _U(0xD1B54A32D192ED03)
        drawn = _mixed(cells[:, None] + index)
        gaps = -np.log(((drawn >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        arrival = rank[:, None] + np.cumsum(gaps, axis=1)
        near = arrival <= reach
        ranks.append(arrival[near])
        hashes.append(drawn[near])
        going = near[:, -1]
        cells, rank, thrown = cells[going], arrival[going, -1], thrown + at_once
    return np.concatenate(ranks), np.concatenate(hashes)


def cells_of(hashes: np.ndarray, weighted: bool = False) -> np.ndarray:
    """Units of weight of a document's shingles: one for each distinct shingle or, `weighted`, one
    for each time it occurs."""
    values, counts = np.unique(hashes, return_counts=True)
    if not weighted:
        return values
    values = np.repeat(values, counts)
    unit = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
    return _mixed(values + unit.astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def band_keys(mark: np.ndarray, bands: int) -> np.ndarray:
    rows = len(mark) // bands
    odd = _mixed(np.arange(1, rows + 1, dtype=np.uint64)) | _U(1)
    return _mixed((_mixed(mark.reshape(bands, rows)) * odd).sum(1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct shingles."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if both else 0.0


def node_of(text_col: str = "text") -> Column:
    """A 128-bit key of the text's words."""
    return F.substring(F.unhex(F.sha2(F.trim(normalized(text_col)), 256)), 1, 16)


def signatures(docs: DataFrame, bands: int, rows: int, words: int, weighted: bool, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, node, buckets, size): the key of each document's words, its band keys, and its number of
    cells."""
    ship(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("doc_id"), node_of(text_col).alias("node"), text_or_empty(text_col).alias("text"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes, cells = [], [0], []
            for text in batch.column(2):
                cells.append(cells_of(shingles(text.as_py(), words), weighted))
                mark = signature(cells[-1], bands * rows)
                values.append(band_keys(mark, bands) if len(mark) else mark)
                sizes.append(len(values[-1]))
            flat = np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat))
            columns = [batch.column(0), batch.column(1), lists, pa.array(map(len, cells), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "buckets", "size"])

    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(signed, f"doc_id {kind}, node binary, buckets array<long>, size long")


def _similar(pairs: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """The (a, b) pairs of nodes whose texts' shingles agree to `least`."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("_one"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("_two"))
    both = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", "_one", "_two")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = lru_cache(maxsize=64)(lambda text: np.unique(shingles(text, words)))
        for batch in batches:
            ones, twos = batch.column(2), batch.column(3)
            fit = [similarity(sets(x.as_py()), sets(y.as_py())) >= least for x, y in zip(ones, twos)]
            yield pa.RecordBatch.from_arrays(
                [column.filter(pa.array(fit, pa.bool_())) for column in batch.columns[:2]], ["a", "b"]
            )

    return both.mapInArrow(compared, "a binary, b binary")


def linked(sets: list[np.ndarray], comps: list, cross: int, least: float) -> list[tuple[int, int]]:
    """Links (i, j) that join all components among the sets which links join: between the first `cross`
    sets and the others or, without `cross`, between any two. Sets hold sorted distinct shingles.

    Every set is ordered by how rare its shingles are here. Two sets of similarity `least` share one of
    the rarest in both, as no more than the others can be missing.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    starts = np.cumsum(sizes) - sizes
    _, ids, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.empty(len(often), dtype=np.int64)
    place[np.argsort(often, kind="stable")] = np.arange(len(often))
    ranks = place[ids]
    own = [np.sort(ranks[b:b + k]) for b, k in zip(starts.tolist(), sizes.tolist())]
    prefix = [x[:len(x) - int(np.ceil(least * len(x) - 1e-9)) + 1] for x in own]

    root: dict = {}

    def top(x):
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    index: dict[int, list[int]] = {}
    found, flags = [], np.zeros(len(often), dtype=bool)
    for i in range(n):
        if i >= cross:  # without `cross`, each looks among those before it
            near = {j for rank in prefix[i].tolist() for j in index.get(rank, ())}
            mine = top(comps[i])
            near = [j for j in sorted(near) if top(comps[j]) != mine]
            if near:
                flags[own[i]] = True
                begin = np.cumsum([0] + [len(own[j]) for j in near[:-1]])
                both = np.add.reduceat(flags[np.concatenate([own[j] for j in near])], begin, dtype=np.int64)
                flags[own[i]] = False
                for j in np.array(near)[both / (sizes[i] + sizes[near] - both) >= least].tolist():
                    one, two = top(comps[i]), top(comps[j])
                    if one != two:
                        root[one] = two
                        found.append((j, i))
        if i < cross or not cross:
            for rank in prefix[i].tolist():
                index.setdefault(rank, []).append(i)
    return found


def _block_links(dealt: DataFrame, words: int, least: float) -> DataFrame:
    """(a, b) links between members of different components in blocks `one` and `two` of a bucket."""
    keys = ["bucket", "one", "two"]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows)
            node, comp = table.column("node").to_pylist(), table.column("comp").to_pylist()
            sets = [np.unique(shingles(text.as_py(), words)) for text in table.column("text")]
            cross = 0 if table.column("one")[0] == table.column("two")[0] else pc.sum(pc.invert(table.column("second"))).as_py()
            pairs = [(node[i], node[j]) for i, j in linked(sets, comp, cross, least)]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])

        held, key = [], None
        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in range(3)]
            change = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
            for column in columns:
                change |= column[1:] != column[:-1]
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                at = tuple(column[begin] for column in columns)
                if held and at != key:  # the last blocks may go on in the next batch
                    yield links(held)
                    held = []
                key = at
                held.append(batch.slice(begin, end - begin))
        if held:
            yield links(held)

    rows = dealt.select(*keys, "second", "node", "comp", "text")
    return rows.repartition(*keys).sortWithinPartitions(*keys, "second").mapInArrow(compared, "a binary, b binary")


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _texts(docs: DataFrame, signed: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of the given nodes, each from the document with its smallest id, so that copies are
    not moved; the ids are looked for first, and only what has one is hashed again."""
    smallest = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"))  # copies are one row before they meet
    first = saved(smallest.join(nodes.hint("merge"), "node", "left_semi"), "first")
    ids = saved(first.select(F.col("doc_id").alias("_id")).distinct(), "ids")
    given = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    some = listed(given, ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    keys = first.select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("node") == F.col("_node"))
    texts = saved(listed(some.withColumn("node", node_of("text")), keys, same, "left_semi").select("node", "text"), "texts")
    if texts.count() == first.count():
        return texts
    return saved(texts.dropDuplicates(["node"]), "texts")  # rows that repeat id and text


def _placed(members: DataFrame, found: DataFrame | None) -> DataFrame:
    if found is None:
        return members.withColumn("comp", F.col("node"))
    return members.join(found.hint("merge"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _dealt(rest: DataFrame, group: int) -> DataFrame:
    """(bucket, one, two, second, node, comp): members of buckets with several components, dealt into
    blocks of about `group` members or the shingles of so many long texts; a row for each two blocks
    that are to be compared. The largest component has blocks of its own, which are only compared with
    others."""
    each = rest.groupBy("bucket", "comp").agg(F.count("*").alias("_n"), F.sum("size").alias("_size"))
    whole = each.groupBy("bucket").agg(
        F.max(F.struct("_n", "comp", "_size")).alias("_main"), F.sum("_n").alias("_n"), F.sum("_size").alias("_size"),
        F.count("*").alias("_comps"),
    ).where("_comps > 1")

    def blocks(rows, size):
        return F.greatest(F.ceil(rows / group), F.ceil(size / (group * BLOCK_SHINGLES))).cast("long")

    counts = saved(whole.select(
        "bucket", F.col("_main.comp").alias("_main"),
        blocks(F.col("_n") - F.col("_main._n"), F.col("_size") - F.col("_main._size")).alias("_others"),
        blocks(F.col("_main._n"), F.col("_main._size")).alias("_mains"),
    ), "counts")
    main = F.col("comp") == F.col("_main")
    hashed = F.xxhash64("node", F.lit(1))
    block = F.when(main, F.col("_others") + F.pmod(hashed, F.col("_mains"))).otherwise(F.pmod(hashed, F.col("_others")))
    last = F.when(main, F.col("_others")).otherwise(F.col("_others") + F.col("_mains")) - 1
    rows = rest.join(counts.hint("merge"), "bucket").select(
        "bucket", "node", "comp", block.alias("_block"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_with")
    )
    one, two = F.least("_block", "_with"), F.greatest("_block", "_with")
    return rows.select("bucket", one.alias("one"), two.alias("two"), (F.col("_block") > F.col("_with")).alias("second"), "node", "comp")


def near_links(
    docs: DataFrame, signed: DataFrame, words: int, least: float, group: int, id_col: str, text_col: str
) -> DataFrame | None:
    """(node, comp): the component of each node that has a link; None without links."""
    bands = signed.select("node", "size", F.explode("buckets").alias("bucket"))
    key = F.xxhash64("node")
    shared = bands.groupBy("bucket").agg(F.min(key).alias("_low"), F.max(key).alias("_high")).where("_low <> _high")
    members = saved(listed(bands, saved(shared.select("bucket"), "shared"), "bucket", "left_semi").distinct(), "members")
    texts = _texts(docs, signed, saved(members.select("node").distinct(), "nodes"), id_col, text_col)

    centers = saved(members.groupBy("bucket").agg(F.min("node").alias("a")), "centers")
    others = members.join(centers.hint("merge"), "bucket").where("node <> a")
    pairs = saved(_ordered(others.select("a", F.col("node").alias("b"))), "pairs")
    links = saved(_similar(pairs, texts, words, least), "near")
    found = None if links.isEmpty() else components(links)

    # the star has compared its center with all members
    rest = saved(_placed(others.select("bucket", "node", "size"), found), "rest")
    dealt = saved(_dealt(rest, group), "dealt")
    more = saved(_block_links(dealt.join(texts.hint("merge"), "node"), words, least), "near")
    return found if more.isEmpty() else components(links.union(more))


def near_dedup(
    docs: DataFrame,
    least: float = 0.8,
    words: int = 5,
    bands: int = 25,
    rows: int = 5,
    weighted: bool = False,
    group: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, class_size, kept.

    A class is a set of documents connected by links: equal words, or a Jaccard similarity of the
    sets of word shingles of `least` or more. `class_id` is the smallest id in it, null ids last; the
    document that has it stays. A text with fewer words than a shingle, a null one (as an empty one)
    included, is only linked with texts of the same words. Rows that repeat id and words share one
    verdict; `drop_near_copies` leaves one of them. Other columns are not read; an empty table gives
    no rows. `weighted` counts a shingle as often as it occurs when candidates are looked for.
    """
    return _classes(docs, least, words, bands, rows, weighted, group, id_col, text_col).drop("node")


def _classes(docs, least, words, bands, rows, weighted, group, id_col, text_col) -> DataFrame:
    signed = saved(signatures(docs, bands, rows, words, weighted, id_col, text_col), "signatures")
    found = near_links(docs, signed, words, least, group, id_col, text_col)
    keys = signed.select("doc_id", "node")
    placed = saved(_placed(keys, found).select("doc_id", "node", F.hex("comp").alias("comp")), "placed")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    classes = placed.groupBy("comp").agg(
        F.min(order).alias("_first"), F.count("*").alias("class_size")
    )
    counts = classes.select("comp", F.col("class_size").alias("_n"))
    return even_join(placed, classes, "comp", "inner", counts).select(
        "doc_id",
        F.col("_first.doc_id").alias("class_id"),
        "class_size",
        (F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("node") == F.col("_first.node"))).alias("kept"),
        "node",
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one of each class (see `near_dedup`)."""
    how = {"least": 0.8, "words": 5, "bands": 25, "rows": 5, "weighted": False, "group": 512} | how
    verdicts = _classes(docs, id_col=id_col, text_col=text_col, **how).withColumnRenamed("node", "key")
    return keep_rows(docs, node_of(text_col), verdicts, id_col)
