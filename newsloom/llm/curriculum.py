"""Mixing sources to target weights, with weights that change in the course of training.

Column functions only. A source's documents, in the order of a hash, make a stream of words that is
repeated as often as its target asks. Its weight schedule, integrated over training time, is the
words it is asked for up to each time; inverting that gives every document's position. Streams are
cumulated over the parts of a range sort: within a part by a window, over the parts of a source by
another, so neither a large source, nor an id that many rows repeat, meets in one task. The documents
then meet their copies by row, and the copies are sorted by position: that is the training stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ROW, SPACE, looked_up, numbered, saved, text_or_empty, word_count

#: Weight at the begin and the end of training, relative to the mean, for each weight in turn.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
WEIGHTS = (1, 2, 3)


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Add `rank`, the row's place from 0 in the whole order: places within the partitions of a range
    sort, on top of the partitions before."""
    parted = saved(df.orderBy(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = saved(
        parted.groupBy("_part").agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"),
        "starts",
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return looked_up(parted.withColumn("_within", within), starts, "_part").withColumn(
        "rank", F.col("_start") + F.col("_within")
    ).drop("_part", "_within", "_start")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size, turn, target) of a table with one row per source.

    Sources in code point order, null last, take the weights in turn and share the sum of all sizes.
    No target is above `most` times its source's size; what is above is shared again by weight.
    """
    turn = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    rows = saved(
        ranked(sizes, F.asc_nulls_last("source")).select("source", "source_size", turn.alias("turn"), weight.alias("weight")),
        "weights",
    )
    level = 0.0
    while True:  # each round caps more sources: two sums over the sources
        above = F.lit(most) * F.col("source_size") < F.lit(level) * F.col("weight")
        row = rows.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, most * F.col("source_size")).otherwise(0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        after = (row["all"] - row["capped"]) / row["weight"] if row["weight"] else level
        if after == level:
            break
        level = after
    target = F.least((most * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight"))
    return rows.select("source", "source_size", "turn", target.alias("target"))


def position(demanded: Column, turn: Column, schedules=SCHEDULES) -> Column:
    """The time in [0, 1] at which a source has been asked for a share `demanded` of its target: the
    integral of a weight that goes from a to b in a line, inverted."""
    out = None
    for i, (a, b) in enumerate(schedules):
        when = demanded if a == b else (F.sqrt(a * a + (b - a) * (a + b) * demanded) - a) / (b - a)
        out = F.when(turn == i, when) if out is None else out.when(turn == i, when)
    return out


def assign(
    docs: DataFrame,
    weights=WEIGHTS,
    schedules=SCHEDULES,
    most: int = 3,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    whole: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size (words), source_size, target, and `copies`, an
    array of (epoch, words, position) for each time the mix takes the document; `carry` puts the
    document's own columns into a struct `doc`.

    A source's words are taken in the order of a hash of the id until its target is met, up to `most`
    times over; the last document is cut, so the words taken are the whole part of the target. With
    `whole` it is taken or left as a whole, whichever is nearer to the target, for each time the source
    is repeated. The order only depends on ids, texts and sources, so reruns agree; of rows that repeat
    all three either may come first. A null text has no words and is not taken; a null source is a
    source; null or repeated ids are ordered by their texts. An empty table gives no rows.
    """
    how = {"weights": weights, "schedules": schedules, "most": most, "whole": whole}
    if carry:
        held = _held(docs)
        plan = _plan(_sizes(held, source_col, id_col, text_col, "doc."), **how)
        return held.join(plan.hint("merge"), ROW).select(*_COLUMNS, "doc")
    return _plan(_sizes(docs, source_col, id_col, text_col, row=F.monotonically_increasing_id()), **how).select(*_COLUMNS)


_COLUMNS = ("doc_id", "source", "size", "source_size", "target", "copies")


def _held(docs: DataFrame) -> DataFrame:
    """The documents as `doc`, written once with the number of the row."""
    rows = numbered(docs.select(F.struct("*").alias("doc")))
    return saved(rows, "documents", **{"compression": "zstd", "parquet.compression.codec.zstd.level": "6"})


def _sizes(rows: DataFrame, source_col: str, id_col: str, text_col: str, inside: str = "", row: Column | None = None) -> DataFrame:
    """What a document's place depends on, with `row` as the number of the row."""
    doc_id, source, text = (F.col(f"{inside}`{name}`") for name in (id_col, source_col, text_col))
    return saved(rows.select(  # the sort reads its input twice
        doc_id.alias("doc_id"), source.alias("source"), word_count(text).alias("size"),
        F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("")).alias("_held"),  # null-free
        F.unhex(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))).alias("_key"), F.xxhash64(text_or_empty(text)).alias("_text"),
        (F.col(ROW) if row is None else row).alias(ROW),
    ), "sizes")


def _plan(rows: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, most: int = 3, whole: bool = False) -> DataFrame:
    """The columns of `assign`, and the number of the row, for the rows of `_sizes`."""
    order = ["_key", "_text", ROW]
    rows = saved(rows.orderBy("_held", *order).withColumn("_part", F.spark_partition_id()), "ordered")
    sums = saved(rows.groupBy("_held", "source", "_part").agg(F.sum("size").alias("_size")), "sums")
    sources = saved(targets(sums.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, most), "targets")
    before = Window.partitionBy("_held").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_held", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_held", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(starts.hint("merge"), ["_held", "_part"])
    placed = looked_up(placed, sources, "source").withColumn("_from", F.col("_start") + F.col("_within"))

    def copy(epoch):
        begin = F.col("_from") + epoch * F.col("source_size")
        words = F.greatest(F.least(F.floor("target") - begin, F.col("size")), F.lit(0)).cast("long")
        if whole:
            words = F.when(2 * words >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("long"))
        return F.struct(
            epoch.cast("int").alias("epoch"), words.alias("words"),
            position(F.try_divide(begin, F.col("target")), F.col("turn"), schedules).alias("position"),
        )

    epochs = F.array(*[F.lit(e) for e in range(most)])
    copies = F.filter(F.transform(epochs, copy), lambda c: c["words"] > 0)
    return placed.select(ROW, "doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def _stream(held: DataFrame, plan: DataFrame, text_col: str) -> DataFrame:
    """The copies in the order of their positions: `doc` as it was, its `text` as the mix takes it."""
    copies = plan.select(ROW, "doc_id", "size", F.inline("copies"))
    whole = F.col(f"doc.`{text_col}`")
    first = F.array_join(F.slice(F.split(F.trim(F.regexp_replace(whole, SPACE, " ")), " "), F.lit(1), F.col("words").cast("int")), " ")
    stream = held.join(copies.hint("merge"), ROW).orderBy("position", "epoch", "doc_id")
    return stream.withColumn("text", F.when(F.col("words") < F.col("size"), first).otherwise(whole))


def _planned(docs: DataFrame, text_col: str, source_col: str = "source", id_col: str = "doc_id", **how) -> tuple[DataFrame, DataFrame]:
    held = _held(docs)
    return held, saved(_plan(_sizes(held, source_col, id_col, text_col, "doc."), **how), "plan")


def mixed(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The training stream: the columns of `docs`, a row for each copy the mix takes, range-sorted by
    position. A document that is cut keeps its first words, one space between them; with `whole=True`
    none is cut and every text is an input's."""
    stream = _stream(*_planned(docs, text_col, **how), text_col)
    return stream.select(*[F.col("text").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def taken(docs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, and what the training stream
    of `mixed` holds of it: `taken`, the words of all its copies, and `first_position`, where the first one
    is; null if there is none. The words are counted in the texts of the ordered stream."""
    needed = dict.fromkeys([how.get("id_col", "doc_id"), how.get("source_col", "source"), text_col])
    held, plan = _planned(docs.select(*[F.col(f"`{name}`") for name in needed]), text_col, **how)
    stream = _stream(held, plan, text_col).select(ROW, word_count("text").alias("words"), "position")
    met = saved(stream, "stream").groupBy(ROW).agg(F.sum("words").alias("taken"), F.min("position").alias("first_position"))
    return plan.join(met.hint("merge"), ROW, "left").select(
        *_COLUMNS[:-1], F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), "first_position"
    )
