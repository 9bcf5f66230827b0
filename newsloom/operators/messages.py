"""JSON news messages: flatten to articles, format as lines, build messages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from ..fixed_values import ARTICLE_DEFAULTS, LINE_FORMAT
from ..functions import settle


def flatten_articles(
    messages: DataFrame, value_col: str = "value", defaults=ARTICLE_DEFAULTS, keep: tuple[str, ...] = (),
    observe: str | Observation | None = None,
) -> DataFrame:
    """One row per article of every message. A message that is no JSON object, or whose `articles` is not
    an array, gives no rows; `observe` names an observation that counts these as `unreadable` of all
    `messages`. A missing or null field gets its default; an element that is no object has them all.

    Of a repeated key the last value counts. No session setting and no size limit of a type has a part
    in it: messages are parsed as arrays of texts, and each text as an article. (So an element that is a
    text with an object inside is read as that object.)
    """
    articles = F.from_json(value_col, "articles array<string>")["articles"]
    if observe is not None:
        messages = settle(messages, "_articles", articles)
        articles = F.col("_articles")
        messages = messages.observe(
            observe, F.count(F.lit(1)).alias("messages"), F.count_if(articles.isNull()).alias("unreadable")
        )
    found = messages.select(*keep, F.explode(articles).alias("_article"))
    parsed = F.from_json("_article", ", ".join(f"`{name}` string" for name in defaults))
    fields = [F.coalesce(F.col(f"_fields.{name}"), F.lit(default)).alias(name) for name, default in defaults.items()]
    return settle(found, "_fields", parsed).select(*keep, *fields)


def article_lines(articles: DataFrame) -> DataFrame:
    """One text line per article. Line breaks in a title would cut the line: white space in
    titles becomes one blank."""
    title = F.regexp_replace("title", r"\s+", " ")
    return articles.select(F.format_string(LINE_FORMAT, title, F.col("publishedAt")).alias("line"))


def to_messages(
    articles: DataFrame, group_cols: tuple[str, ...] = (), per_message: int = 100, most_bytes: int = 900_000
) -> DataFrame:
    """Pack articles into JSON messages of at most `per_message` articles and `most_bytes` bytes, one
    group per message. An article that alone is larger has a message of its own.

    Each task packs the rows it has, batch by batch. No row is shuffled and no message grows with
    the data, whatever share of the rows a group holds; and no later step depends on which rows
    came together, so a task that is run again does no harm.
    """
    fields = [c for c in articles.columns if c not in group_cols]
    article = F.struct(*fields)
    size = (F.octet_length(F.to_json(article)) + 1).cast("long")
    packable = articles.select(*group_cols, size.alias("_size"), article.alias("_article"))
    room = most_bytes - len('{"articles":[]}')
    schema = StructType([StructField("articles", ArrayType(packable.schema["_article"].dataType))])

    # Inner functions travel to the workers by value: these need not have this package.

    def grouped(batch):
        """The rows with equal groups side by side, and the places where a message begins."""
        place = np.arange(batch.num_rows)
        begins = place == 0
        if group_cols:
            batch = batch.take(pc.sort_indices(batch, sort_keys=[(c, "ascending") for c in group_cols]))
            for c in group_cols:
                codes = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy()
                begins[1:] |= codes[1:] != codes[:-1]
        starts, count, held = [], 0, 0
        for i, (begin, size) in enumerate(zip(begins.tolist(), batch.column("_size").to_pylist())):
            if begin or count == per_message or held + size > room:
                starts.append(i)
                count = held = 0
            count, held = count + 1, held + size
        return batch, np.array(starts)

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                rows, begins = grouped(batch)
                offsets = pa.array(np.append(begins, rows.num_rows), pa.int32())
                packed = pa.ListArray.from_arrays(offsets, rows.column("_article"))
                yield pa.RecordBatch.from_arrays([packed], ["articles"])

    return packable.mapInArrow(pack, schema).select(
        F.lit(None).cast("string").alias("key"), F.to_json(F.struct("articles")).alias("value")
    )
