"""Ranked lexical search, reversed: the items are indexed and every document is run through the index.

The inverted index of a block of items (term to the items that hold it) travels to the tasks. Each
document's term counts stream through it, the scores of one document for all items are added up by
its terms, and each task keeps a bounded heap for each item. The heaps are merged in two steps.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import ROW, numbered, saved, ship, text_or_empty

#: Maximal runs of characters that are no ASCII sign, in UTF-8 after lower-casing A to Z.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

ITEM_BYTES = 16 << 20  # text of the items of a block, unless one alone is longer
CELLS = 1 << 20  # (document, item) scores held at a time
MERGE_PARTS = 64


def terms_of(data: bytes) -> list[bytes]:
    """The terms of a text in UTF-8. `bytes.lower` touches A to Z only."""
    return _TERM.findall(data.lower())


@dataclass
class Index:
    """An inverted index of items: `places` numbers the terms; `rows`, `times` and `starts` are the
    items that hold each term and how often."""

    ids: list
    places: dict[bytes, int]
    starts: np.ndarray
    rows: np.ndarray
    times: np.ndarray


def index_items(items: list[tuple[object, str | None]]) -> Index:
    """Index (id, text) items; items without terms stay without postings."""
    postings: dict[bytes, list[tuple[int, int]]] = {}
    for row, (_, text) in enumerate(items):
        for term, n in Counter(terms_of((text or "").encode())).items():
            postings.setdefault(term, []).append((row, n))
    lists = list(postings.values())
    flat = np.array([one for items_of in lists for one in items_of], np.int64).reshape(-1, 2)
    starts = np.concatenate([[0], np.cumsum([len(items_of) for items_of in lists])]).astype(np.int64)
    return Index([i for i, _ in items], {term: k for k, term in enumerate(postings)}, starts, flat[:, 0], flat[:, 1])


def term_rows(docs: DataFrame, places, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tf) of each document that has a term: its number of terms, and the indexed
    ones among them with their counts. `places` is a broadcast of an index's terms."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    fields = [
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.LongType())),
    ]
    id_type = to_arrow_type(fields[0].dataType)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = places.value
        for batch in batches:
            sizes, held, kept = [], [], []
            for i, data in enumerate(batch.column(1).cast(pa.binary())):
                found = terms_of(data.as_py())
                if found:
                    kept.append(i)
                    sizes.append(len(found))
                    held.append(np.unique([known[term] for term in found if term in known], return_counts=True))
            if not kept:
                continue
            ends = np.cumsum([0, *(len(one) for one, _ in held)])
            columns = [
                batch.column(0).take(pa.array(kept)).cast(id_type), pa.array(sizes, pa.int64()),
                *(
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(part).astype(kind)))
                    for part, kind in zip(zip(*held), (np.int32, np.int64))
                ),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tf"])

    return rows.mapInArrow(counted, T.StructType(fields))


@dataclass
class Scorer:
    """What a task needs to score documents: the index, its terms' weights, and the corpus."""

    index: Index
    weights: np.ndarray
    docs: int
    terms: int

    def scores(self, sizes: list[int], ends: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """(documents, items) scores of documents with `sizes` terms; those of document i that are
        indexed lie from ends[i] to ends[i + 1]."""
        index, width = self.index, len(self.index.ids)
        m = np.array([25 + (75 * n * self.docs) // self.terms for n in sizes], np.int64)  # in whole numbers of any size
        doc = np.repeat(np.arange(len(sizes)), np.diff(ends))
        worth = self.weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        counts = index.starts[terms + 1] - index.starts[terms]
        first = np.repeat(index.starts[terms] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        places = first + np.arange(len(first))
        cell = np.repeat(doc, counts) * width + index.rows[places]
        value = np.repeat(worth, counts) * index.times[places]
        # sums of floats are exact below 2**53: the upper and lower bits are summed apart
        upper, lower = (np.bincount(cell, part, len(sizes) * width) for part in (value >> 24, value & 0xFFFFFF))
        return (upper.astype(np.int64) * (1 << 24) + lower.astype(np.int64)).reshape(len(sizes), width)


def _best(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, items: list[tuple], item_type: T.DataType, k: int, id_col: str, text_col: str) -> DataFrame:
    context = docs.sparkSession.sparkContext
    index = index_items(items)
    counted = saved(term_rows(docs, context.broadcast(index.places), id_col, text_col), "term-counts")
    total = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    # at most one row for each indexed term
    found = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()
    frequency = np.zeros(len(index.places), np.int64)
    for row in found:
        frequency[row["term"]] = row["df"]
    weights = [math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * int(df) + 1))) for df in frequency]
    scorer = context.broadcast(Scorer(index, np.array(weights, np.int64), total["docs"], total["terms"] or 1))
    doc_type = counted.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("item", T.LongType()), T.StructField("item_id", item_type),
        T.StructField("doc_id", doc_type), T.StructField("score", T.LongType()),
    ])
    types = [to_arrow_type(field.dataType) for field in schema]

    def heaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = scorer.value
        ids = tool.index.ids
        best = [[] for _ in ids]  # of (score, has an id, -id), the worst first
        least = np.ones(len(ids), np.int64)  # no document below can enter
        step = max(1, CELLS // max(1, len(ids)))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                terms, tf = part.column(2), part.column(3)
                offsets = terms.offsets.to_numpy().astype(np.int64)
                scores = tool.scores(
                    part.column(1).to_pylist(), offsets - offsets[0], terms.flatten().to_numpy().astype(np.int64), tf.flatten().to_numpy()
                )
                docs_of, items_of = np.nonzero(scores >= least)
                doc_ids = part.column(0).to_pylist()
                for d, i, score in zip(docs_of.tolist(), items_of.tolist(), scores[docs_of, items_of].tolist()):
                    doc_id, heap = doc_ids[d], best[i]
                    one = (score, doc_id is not None, -(doc_id or 0))
                    if len(heap) < k:
                        heapq.heappush(heap, one)
                    elif one > heap[0]:
                        heapq.heapreplace(heap, one)
                    if len(heap) == k:
                        least[i] = heap[0][0]
        rows = [(i, ids[i], -neg if known else None, score) for i, heap in enumerate(best) for score, known, neg in heap]
        if rows:
            columns = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    found = counted.mapInArrow(heaps, schema).withColumn("part", F.spark_partition_id() % MERGE_PARTS)
    merged = _best(_best(found, k, "item", "part").drop("rank"), k, "item")
    return merged.select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """The `k` documents of highest score above 0 for each item: item_id, rank (from 1), doc_id, score.

    Whole texts are searched; df, N and L count all documents. Of equal scores the smaller id comes
    first, a null id last; ids are whole numbers. A null text has no terms: such a document is never
    found and counts nowhere, such an item finds nothing. Rows that repeat an id are documents, or
    items, of their own. Other columns are not read; without documents or items there are no rows.

    Items are taken in blocks of `item_bytes` of text, each of which reads the documents once: what is
    broadcast is bounded by a block, and what a task returns by `k` rows for each of its items.
    """
    ship(docs.sparkSession)
    rows = items.select(F.col(item_id_col).alias("item_id"), text_or_empty(item_text_col).alias("text"))
    rows = saved(numbered(rows), "items")
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // item_bytes))
    kind = rows.schema["item_id"].dataType
    done = []
    for block in range(blocks):
        mine = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64(ROW), F.lit(blocks)) == block)
        held = [(r["item_id"], r["text"]) for r in mine.orderBy(ROW).collect()]
        done.append(_search_block(docs, held, kind, k, id_col, text_col))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found
