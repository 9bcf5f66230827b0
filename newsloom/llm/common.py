"""What several operators share: whole-text keys, scratch tables, row numbers, shipping code."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_dir

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
ROW = "_row"


def text_or_empty(text="text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def normalized(text="text") -> Column:
    """The text with each run of white space as one space; a null text is empty."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


def word_count(text="text") -> Column:
    """Number of words: each, with the white space before it, becomes one sign; what is left after the
    last is taken away."""
    signs = F.regexp_replace(text_or_empty(text), rf"[\x20\x09-\x0D]*{WORD}", "x")
    return F.length(F.translate(signs, " \t\n\x0b\x0c\r", "")).cast("long")


def saved(df: DataFrame, name: str, **options) -> DataFrame:
    """The rows as a table in the shared scratch folder: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """Add `_row`, a number of the row. Nothing but a written table keeps it the same in two reads,
    so callers save what they made from it before they use it twice."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unit(*columns) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)).cast("double") / float(1 << 40)


def blocks_for(rows: int) -> int:
    """Over how many blocks to spread `rows` so that neither the rows of a block nor the number of
    blocks grows faster than the square root of the rows."""
    return max(1, math.isqrt(max(0, rows)))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, for sessions whose workers do not find it."""
    context = spark.sparkContext
    if getattr(context, "_newsloom_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="newsloom-"), f"newsloom_{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._newsloom_shipped = True


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until `df` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


#: Rows and bytes of a saved table that may be broadcast; a larger one is shuffled, with the same result.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def broadcastable(table: DataFrame) -> bool:
    """Whether a saved table may be broadcast: its rows are counted (a written table has that in its
    footers), then the bytes of its texts, and 16 bytes for each column and for the row's two places in a
    hash table."""
    rows = table.count()
    fixed = 16 * (len(table.columns) + 2) * rows
    if rows > BROADCAST_ROWS or fixed > BROADCAST_BYTES:
        return False
    wide = [F.sum(F.octet_length(name)) for name, kind in table.dtypes if kind in ("string", "binary")]
    return not wide or fixed + sum(n or 0 for n in table.agg(*wide).first()) <= BROADCAST_BYTES


def listed(docs: DataFrame, keys: DataFrame, on, how: str) -> DataFrame:
    """Semi or anti join of documents with a saved list of short keys, broadcast behind a check of its
    rows and bytes."""
    small = broadcastable(keys)
    return docs.join(F.broadcast(keys) if small else keys.hint("merge"), on, how)


def drop_rows(docs: DataFrame, key, verdicts: DataFrame, id_col: str) -> DataFrame:
    """`docs` without the rows that (doc_id, key, kept) verdicts reject. `key` is the column of `docs`
    that the verdicts' key comes from; id and key together name a row, as an id may repeat."""
    name, value, own = fresh(docs, "_id", "_key", "_own_key")
    gone = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias(name), F.col("key").alias(value)).distinct()
    same = F.col(id_col).eqNullSafe(F.col(name)) & (F.col(own) == F.col(value))
    return listed(docs.withColumn(own, key), saved(gone, "gone"), same, "left_anti").drop(own)


def keep_rows(docs: DataFrame, key, verdicts: DataFrame, id_col: str) -> DataFrame:
    """`drop_rows`, and of kept rows that repeat id and key, one."""
    verdicts = saved(verdicts.select("doc_id", "key", "kept"), "verdicts")
    kept = drop_rows(docs, key, verdicts, id_col)
    name, value, own = fresh(docs, "_id", "_key", "_own_key")
    repeated = saved(
        verdicts.where("kept").groupBy(F.col("doc_id").alias(name), F.col("key").alias(value))
        .agg(F.count("*").alias("n")).where("n > 1").drop("n"),
        "repeated",
    )
    if repeated.isEmpty():
        return kept
    kept = kept.withColumn(own, key)
    same = F.col(id_col).eqNullSafe(F.col(name)) & (F.col(own) == F.col(value))
    once = listed(kept, repeated, same, "left_semi").dropDuplicates([id_col, own])
    return listed(kept, repeated, same, "left_anti").unionByName(once).drop(own)


def looked_up(rows: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """Left join with a saved table of one row per key, nulls among the keys being equal. A table
    too large to broadcast is merged; adaptive execution then splits a key with very many rows."""
    names = {key: f"__{key}" for key in keys}
    other = table.withColumnsRenamed(names)
    small = broadcastable(table)
    same = None
    for key, name in names.items():
        one = F.col(key).eqNullSafe(F.col(name))
        same = one if same is None else same & one
    joined = rows.join(F.broadcast(other) if small else other.hint("merge"), same, "left")
    return joined.drop(*names.values())
