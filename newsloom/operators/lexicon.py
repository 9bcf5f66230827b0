"""Lookups of tokens in lexicon tables: part-of-speech tags, lemmas, embeddings.

Token rows are joined with the lexicon. Token arrays are looked up where they are: a lexicon of a
checked size travels to the tasks, and no token is shuffled.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import settle, shape_of
from ..session import scratch_dir
from ..word_shapes import POS_OTHER, POS_SHAPES, POS_WORDS

#: A table of at most so many rows and bytes travels to the tasks; the results do not depend on it.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def normalize_lexicon(lexicon: DataFrame, value_col: str, fold: bool = False) -> DataFrame:
    """(token, value): one row per token, the smallest value where a token has several; `fold` puts
    tokens in lower case. Rows without a token or a value are left out. Every lookup uses it."""
    token = F.lower("token") if fold else F.col("token")
    known = lexicon.where(F.col("token").isNotNull() & F.col(value_col).isNotNull())
    return known.groupBy(token.alias("token")).agg(F.min(value_col).alias(value_col))


def fits(table: DataFrame, rows: int, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the table has at most `rows` rows and `most_bytes` of content. Both are summed where the rows
    are, the bytes only where the number allows it: no row moves."""
    if rows <= 0 or table.agg(F.count("*")).first()[0] > rows:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct(*table.columns))))
    return (table.agg(size).first()[0] or 0) <= most_bytes


def saved(df: DataFrame, name: str) -> DataFrame:
    """A small table written to the shared scratch folder, so that it is made once."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def even_join(
    rows: DataFrame, table: DataFrame, on: str, how: str = "left", counts: DataFrame | None = None, shares: int | None = None
) -> DataFrame:
    """Equi-join of many rows with a large table of one row per key, whatever share a key holds.

    Keys with more rows than an even share of a task are counted first (`counts`: a (key, _n) table,
    if there is one already). There are fewer of them than tasks, so their entries are broadcast, and
    their rows are spread by a hash of the row; all other keys are merged. No entry is copied but
    those of hot keys, and each row is shuffled once.
    """
    shares = shares or max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if counts is None:
        counts = rows.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n"))
    counts = saved(counts.select(on, "_n"), "key-counts")
    even = (counts.agg(F.sum("_n")).first()[0] or 0) / shares
    entries = table.select(on, F.struct(*[c for c in table.columns if c != on]).alias("_entry"))
    hot = counts.where(F.col("_n") > even).select(on).join(entries, on, "left")
    hot = hot.select(F.col(on).alias("_hot"), F.col("_entry").alias("_hot_entry"))
    known = rows.join(F.broadcast(hot), F.col(on) == F.col("_hot"), "left")
    away = F.concat(F.lit("\0"), F.xxhash64(*rows.columns).cast("string"))  # meets no entry
    keyed = known.withColumn("_merge", F.when(F.col("_hot").isNull() & F.col(on).isNotNull(), F.col(on)).otherwise(away))
    found = keyed.join(entries.withColumnRenamed(on, "_merge").hint("merge"), "_merge", "left")
    found = found.withColumn("_entry", F.coalesce("_hot_entry", "_entry"))
    if how == "inner":
        found = found.where(F.col("_entry").isNotNull())
    return found.select(*rows.columns, "_entry.*")


def lookup(
    rows: DataFrame, lexicon: DataFrame, on: str = "token", how: str = "left", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join token rows with a lexicon that has one row per `on`: broadcast where its size is
    checked, else by `even_join`, with the same result."""
    if fits(lexicon, broadcast_rows):
        return rows.join(F.broadcast(lexicon), on, how)
    return even_join(rows, lexicon, on, how)


def train_pos_lexicon(tagged: DataFrame, token_col: str = "token", tag_col: str = "tag") -> DataFrame:
    """(token, tag): the most frequent tag of each token, the first in the alphabet on a tie."""
    counted = tagged.groupBy(F.col(token_col).alias("token"), F.col(tag_col).alias("tag")).count()
    best = F.min_by("tag", F.struct(-F.col("count"), "tag"))
    return counted.groupBy("token").agg(best.alias("tag"))


def pos_words(spark: SparkSession, words=POS_WORDS) -> DataFrame:
    """The built-in closed-class lexicon as a (token, tag) table."""
    pairs = [
        F.struct(F.lit(token).alias("token"), F.lit(tag).alias("tag"))
        for tag, tokens in words.items()
        for token in tokens
    ]
    table = spark.range(1).select(F.inline(F.array(*pairs)))
    return table.groupBy("token").agg(F.min("tag").alias("tag"))


def shape_tag(token, shapes=POS_SHAPES, other: str = POS_OTHER) -> Column:
    return shape_of(token, shapes, other)


def pos_tag(
    rows: DataFrame, lexicon: DataFrame, shapes=POS_SHAPES, token_col: str = "token", **lookup_args
) -> DataFrame:
    """Add `pos_tag`: the lexicon's tag of the token, whatever the case of either, else the tag of
    the token's shape."""
    entries = normalize_lexicon(lexicon, "tag", fold=True).select(F.col("token").alias("_lowered"), F.col("tag").alias("_tag"))
    found = lookup(rows.withColumn("_lowered", F.lower(token_col)), entries, "_lowered", **lookup_args)
    return found.withColumn("pos_tag", F.coalesce("_tag", shape_tag(token_col, shapes))).drop(
        "_lowered", "_tag"
    )


def lemmatize(rows: DataFrame, lexicon: DataFrame, token_col: str = "token", **lookup_args) -> DataFrame:
    """Add `lemma`: the lexicon's lemma of the token, else the token itself."""
    entries = normalize_lexicon(lexicon, "lemma").select(F.col("token").alias(token_col), F.col("lemma").alias("_lemma"))
    found = lookup(rows, entries, token_col, **lookup_args)
    return found.withColumn("lemma", F.coalesce("_lemma", token_col)).drop("_lemma")


def embed(rows: DataFrame, vectors: DataFrame, token_col: str = "token", **lookup_args) -> DataFrame:
    """Add `vector`: the embedding of the token, null for unknown tokens."""
    entries = normalize_lexicon(vectors, "vector").select(F.col("token").alias(token_col), "vector")
    return lookup(rows, entries, token_col, **lookup_args)


def content_key(tokens: str) -> Column:
    """A key for the content of a token array: equal arrays, and no others, have equal keys."""
    return F.sha2(F.to_json(tokens), 256)


def carried(entries: pa.Table, value_type: str):
    """A function from an array column to the array of values in a two-column table that travels
    to the tasks. All elements of a batch are looked up in one vectorized pass."""
    keys = entries.column(0).combine_chunks().cast(pa.string())
    values = entries.column(1).combine_chunks()

    @F.arrow_udf(f"array<{value_type}>")
    def look(tokens: pa.Array) -> pa.Array:
        found = values.take(pc.index_in(tokens.values.cast(pa.string()), value_set=keys))
        missing = tokens.is_null() if tokens.null_count else None
        return pa.ListArray.from_arrays(tokens.offsets, found, mask=missing)

    return look


def _joined(df: DataFrame, entries: DataFrame, tokens_col: str, out: str) -> DataFrame:
    """Values for token arrays by a join, for a lexicon too large to travel. They depend on the
    tokens alone, so they are put together by content: no id is needed. Only the different tokens of an
    array are joined, and only those found come back to it."""
    keyed = settle(df, "_key", F.unhex(content_key(tokens_col)))
    different = lambda rows, *kept: rows.select(*kept, F.explode(F.array_distinct(tokens_col)).alias("_token")).where("_token is not null")
    counts = different(df).groupBy("_token").agg(F.count("*").alias("_n"))
    values = (
        even_join(different(keyed, "_key"), entries, "_token", "inner", counts)
        .groupBy("_key")
        .agg(F.collect_set(F.struct("_token", "_value")).alias("_values"))
    )
    found = keyed.join(values.hint("merge"), "_key", "left")
    none = F.array().cast(values.schema["_values"].dataType)
    found = settle(found, "_values", F.coalesce("_values", none))

    @F.arrow_udf(f"array<{entries.schema['_value'].dataType.simpleString()}>")
    def placed(tokens: pa.Array, values: pa.Array) -> pa.Array:
        offsets, bounds = tokens.offsets.to_pylist(), values.offsets.to_pylist()
        flat = values.values.slice(bounds[0], bounds[-1] - bounds[0])
        known, words = pc.struct_field(flat, "_token").to_pylist(), tokens.values.to_pylist()
        places = []
        for begin, end, first, last in zip(offsets, offsets[1:], bounds, bounds[1:]):
            at = {word: i for i, word in enumerate(known[first - bounds[0]:last - bounds[0]], first - bounds[0])}
            places += [at.get(word) for word in words[begin:end]]
        missing = tokens.is_null() if tokens.null_count else None
        starts = pa.array([offset - offsets[0] for offset in offsets], pa.int32())
        return pa.ListArray.from_arrays(starts, pc.struct_field(flat, "_value").take(pa.array(places, pa.int64())), mask=missing)

    return settle(found.withColumn(out, placed(tokens_col, "_values")), out, F.col(out)).drop("_key", "_values")


def look_up_arrays(
    df: DataFrame, lexicon: DataFrame, value_col: str, tokens_col: str, out: str, carry_rows: int = BROADCAST_ROWS,
    fold: bool = False,
) -> DataFrame:
    """Add an array with the lexicon's value of each token, null for unknown tokens; a null array
    gives null. A lexicon of a checked size travels to the tasks, a larger one is joined, with the
    same result."""
    entries = normalize_lexicon(lexicon, value_col, fold).select(
        F.col("token").alias("_token"), F.col(value_col).alias("_value")
    )
    if carry_rows <= 0:
        return _joined(df, entries, tokens_col, out)
    entries = saved(entries, "lexicon")
    if not fits(entries, carry_rows):
        return _joined(df, entries, tokens_col, out)
    look = carried(entries.toArrow(), entries.schema["_value"].dataType.simpleString())
    return settle(df.withColumn(out, look(tokens_col)), out, F.col(out))


def _else(df: DataFrame, tokens_col: str, out: str, default) -> DataFrame:
    """Fill unknown tokens' values with `default(token)`."""
    pairs = F.arrays_zip(F.col(tokens_col).alias("token"), F.col(out).alias("value"))
    return settle(df, out, F.transform(pairs, lambda z: F.coalesce(z["value"], default(z["token"]))))


def tag_arrays(
    df: DataFrame, lexicon: DataFrame, tokens_col: str = "token", out: str = "pos", shapes=POS_SHAPES, **args
) -> DataFrame:
    """`pos_tag` for token arrays."""
    lowered = settle(df, "_lowered", F.transform(tokens_col, F.lower))
    found = look_up_arrays(lowered, lexicon, "tag", "_lowered", out, fold=True, **args).drop("_lowered")
    return _else(found, tokens_col, out, lambda token: shape_tag(token, shapes))


def lemma_arrays(df: DataFrame, lexicon: DataFrame, tokens_col: str = "token", out: str = "lemma", **args) -> DataFrame:
    """`lemmatize` for token arrays."""
    found = look_up_arrays(df, lexicon, "lemma", tokens_col, out, **args)
    return _else(found, tokens_col, out, lambda token: token)


def vector_arrays(
    df: DataFrame, vectors: DataFrame, tokens_col: str = "token", out: str = "word_embeddings", **args
) -> DataFrame:
    """`embed` for token arrays."""
    return look_up_arrays(df, vectors, "vector", tokens_col, out, **args)
