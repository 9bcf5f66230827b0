"""Quality rules on whole texts, and lines that too many documents of a host share.

One pass over the texts makes short rows: counts, and a hash with its number of words for each
distinct normalised line. Lines are counted by host and hash, combined before the shuffle. What is
over its host's limit is taken out of each document; a document of which too little is left is
rejected. `line_rules` gives counts and verdicts, `clean_documents` the texts that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ROW, fresh, looked_up, numbered, partitions, saved, ship, text_or_empty
from .dart_minhash import shingles

SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5


def normal_line(line: str) -> bytes:
    """A line's words in lower case, one space between them."""
    return b" ".join(line.lower().encode().split())


def repeated_words(text: str) -> int:
    """Number of words in windows of five words that occur twice or more in the text."""
    windows = shingles(text, WINDOW)
    if not len(windows):
        return 0
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    change = np.zeros(len(windows) + WINDOW, dtype=np.int64)
    starts = np.flatnonzero(again)
    change[starts] += 1
    np.subtract.at(change, starts + WINDOW, 1)
    return int((np.cumsum(change) > 0).sum())


def line_key(line: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(normal_line(line)) - (1 << 63)


def without(text: str, gone: set[int]) -> str:
    """The text without the lines of these keys; lines without a word stay."""
    return "\n".join(line for line in text.split("\n") if not line.encode().split() or line_key(line) not in gone)


def measured(text: str) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, hashes, words) of a text."""
    lines: dict[int, int] = {}
    seen, repeated, words = set(), 0, 0
    for line in text.split("\n"):
        n = len(line.encode().split())
        if not n:
            continue
        words += n
        repeated += line in seen
        seen.add(line)
        key = line_key(line)
        lines[key] = lines.get(key, 0) + n
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    return words, chars, symbols, repeated, repeated_words(text), list(lines), list(lines.values())


_SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<long>, line_words array<long>"
)


#: Lines over their host's limit that are broadcast as a whole; of more, only the most frequent are.
BROADCAST_LINES = 100_000


def _over_limit(rows: DataFrame, max_docs: int, max_share: float | None) -> DataFrame:
    """(_row, gone_words, gone): words in, and hashes of, the lines of a row that are over the limit."""
    counted = rows.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    over = counted.where(F.col("n") > max_docs)
    if max_share is not None:
        hosts = saved(rows.groupBy("host").agg(F.count("*").alias("docs")), "hosts")
        over = looked_up(over, hosts, "host").where(F.col("n") > max_share * F.col("docs"))
    over = saved(over.select(F.col("host").alias("_host"), F.col("line").alias("_line"), "n"), "over")
    pairs = F.arrays_zip(F.col("lines").alias("line"), F.col("line_words").alias("words"))
    lines = rows.select(ROW, "host", F.inline(pairs))
    same = F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line"))
    if over.count() <= BROADCAST_LINES:
        found = lines.join(F.broadcast(over), same)
    else:  # lines of more rows than a task's even share are fewer than the tasks
        even = (rows.agg(F.sum(F.size("lines"))).first()[0] or 0) / partitions(rows.sparkSession)
        hot = F.broadcast(over.where(F.col("n") > even))
        others = lines.join(hot, same, "left_anti").join(over.where(F.col("n") <= even).hint("merge"), same)
        found = lines.join(hot, same).unionByName(others)
    return saved(
        found.groupBy(ROW).agg(F.sum("words").alias("gone_words"), F.collect_list("line").alias("gone")), "over-by-row"
    )


def line_rules(
    docs: DataFrame,
    max_docs: int = 20,
    max_share: float | None = None,
    min_left: float = 0.3,
    host_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and left_words (words outside lines over the limit).

    A line is over its host's limit if more than `max_docs` documents of the host have it, whatever the
    host's size; with `max_share`, only if they are also more than that share of them. A document keeps its place if its base rules hold (10
    words, at most 20 in 100 words in repeated windows) and at least `min_left` of its words are
    left. Each row counts as a document, repeated ones too. A null text is empty and fails; rows
    without a host share one. Other columns are not read; an empty table gives no rows.
    """
    return _judged(docs, max_docs, max_share, min_left, host_col, id_col, text_col).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "left_words"
    )


def _judged(docs, max_docs, max_share, min_left, host_col, id_col, text_col, *more) -> DataFrame:
    """The columns of `line_rules`, host, `gone` (hashes of lines over the limit; null without one), and
    the columns `more` of `docs`."""
    ship(docs.sparkSession)
    given = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), *more, text_or_empty(text_col).alias("text")
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
        for batch in batches:
            rows = [measured(text.as_py()) for text in batch.columns[-1]]
            columns = zip(*rows) if rows else [[]] * 7
            arrays = [pa.array(list(column), kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names)

    before = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema][:-1]
    names = given.columns[:-1] + [part.split()[0] for part in _SCHEMA.split(", ")]
    rows = saved(numbered(given.mapInArrow(measure, ", ".join([*before, _SCHEMA]))), "lines")
    gone = _over_limit(rows, max_docs, max_share).withColumnRenamed(ROW, "_of")
    judged = rows.drop("lines", "line_words").join(gone.hint("merge"), F.col(ROW) == F.col("_of"), "left")
    judged = judged.withColumn("left_words", F.col("n_words") - F.coalesce("gone_words", F.lit(0).cast("long")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~failed & (F.col("left_words") >= min_left * F.col("n_words"))
    return judged.withColumns({"base_failed": failed, "kept": kept}).drop(ROW, "_of", "gone_words")


def clean_documents(
    docs: DataFrame,
    max_docs: int = 20,
    max_share: float | None = None,
    min_left: float = 0.3,
    host_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents that `line_rules` keeps, with all their columns, their texts without the lines over
    the limit: `left_words` words are left. Repeated rows stay."""
    key, name, host, own, gone, kept = fresh(docs, "_key", "_id", "_host", "_own_key", "_gone", "_kept")
    digest = F.sha2(text_or_empty(text_col), 256)
    judged = _judged(docs, max_docs, max_share, min_left, host_col, id_col, text_col, digest.alias("_digest"))
    # rows of the same id, host and text have the same verdict and lines
    verdicts = saved(
        judged.where(~F.col("kept") | F.col("gone").isNotNull())
        .groupBy(F.col("doc_id").alias(name), F.col("host").alias(host), F.col("_digest").alias(key))
        .agg(F.first("kept").alias(kept), F.first("gone").alias(gone)),
        "changed",
    )
    same = F.col(id_col).eqNullSafe(F.col(name)) & F.col(host_col).eqNullSafe(F.col(host)) & (F.col(own) == F.col(key))
    stay = (
        docs.withColumn(own, digest).join(verdicts.hint("merge"), same, "left")
        .where(F.coalesce(kept, F.lit(True))).select(*[F.col(f"`{c}`") for c in docs.columns], gone)
    )
    at = docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            texts, lines = columns[at].to_pylist(), columns.pop().to_pylist()
            texts = [without(text, set(keys)) if keys else text for text, keys in zip(texts, lines)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    names = docs.columns
    return stay.mapInArrow(cut, docs.schema)
