"""Secrets in whole texts, and in how many hands each candidate value is.

Column functions only. A kind's matches and the gaps between them come from one pattern, so a match's
place is the sum of the lengths before it. Candidate values are hashed and counted by distinct owners
and repositories over the whole corpus: a value in many hands is an example that was copied, one that
only a single owner has and that looks random is likely to be live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ROW, numbered, saved, text_or_empty


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: kind: (pattern, group of the value, least length of the value)
KINDS = {
    "assign": (rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
LIVE, COPIED = "live", "copied"
#: The order of kinds that begin at the same place.
ORDER = (*KINDS, LIVE, COPIED)


def _matches(text: Column, kind: str) -> Column:
    """Array of (gap, found, value) of a kind's leftmost matches; null without any."""
    pattern, group, _ = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    return F.when(text.rlike(pattern), F.arrays_zip(gaps.alias("gap"), found.alias("found"), value.alias("value")))


def _placed(rows: DataFrame) -> DataFrame:
    """(row, owner, repo, kind, begin, end, value_begin, value, looks) of each match that fits: `value`
    is a hash, `looks` tells whether the value looks random."""
    matches = None
    for kind, (_, _, least) in KINDS.items():
        each = rows.select(ROW, "owner", "repo", F.lit(kind).alias("kind"), F.posexplode(kind).alias("at", "m"))
        kept = each.select(
            ROW, "owner", "repo", "kind", "at",
            F.length("m.gap").alias("gap"), F.length("m.found").alias("size"), F.col("m.value").alias("value"),
            (F.length("m.value") >= least).alias("fits"),
        )
        matches = kept if matches is None else matches.unionByName(kept)
    up_to = Window.partitionBy(ROW, "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(up_to)
    value = F.col("value")
    looks = (
        (F.length(value) >= 16)
        & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
        & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    )
    return matches.withColumn("end", end).where("fits").select(
        ROW, "owner", "repo", "kind", (F.col("end") - F.col("size")).alias("begin"), "end",
        (F.col("end") - F.length(value)).alias("value_begin"), F.sha2(value, 256).alias("value"), looks.alias("looks"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """(value, owners, repos): in how many hands each hashed value is, over the whole corpus."""
    hands = found.groupBy("value", "owner", "repo").agg(F.lit(1).alias("_one"))
    return hands.groupBy("value").agg(
        F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repos")
    )


def find_secrets(
    docs: DataFrame,
    max_owners: int = 1,
    max_repos: int = 3,
    owner_col: str = "source",
    repo_cols: tuple[str, ...] = ("source", "lang"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, and the arrays `base` and `all`
    of (begin, rank, kind, end) spans in order, in code points with the end excluded.

    `all` adds to the base kinds the spans of values: `live` where at most `max_owners` owners and
    `max_repos` repositories have the value and it looks random (16 characters or more, 8 different
    ones, letters and digits), `copied` where more have it. A null text is empty; documents without an
    owner count as one owner's, as do those without a repository. Repeated rows and ids each get their
    row. Other columns are not read; an empty table gives no rows.
    """
    def filled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(""))

    given = numbered(docs.select(
        F.col(id_col).alias("doc_id"), filled(owner_col).alias("owner"),
        F.concat_ws("/", *map(filled, repo_cols)).alias("repo"), text_or_empty(text_col).alias("text"),
    ))
    rows = saved(
        given.select("doc_id", ROW, "owner", "repo", *[_matches(F.col("text"), kind).alias(kind) for kind in KINDS]),
        "secret-matches",
    )
    found = saved(_placed(rows), "secrets")
    hands = ownership(found)
    judged = found.join(hands.hint("merge"), "value")
    few = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    verdict = F.when(~few, COPIED).when(F.col("looks"), LIVE)

    def span(kind: Column, begin: str) -> Column:
        rank = F.array_position(F.array(*map(F.lit, ORDER)), kind)
        return F.struct(F.col(begin).alias("begin"), rank.alias("rank"), kind.alias("kind"), F.col("end").alias("end"))

    spans = judged.groupBy(ROW).agg(
        *[F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}") for kind in KINDS],
        F.array_sort(F.collect_list(span(F.col("kind"), "begin"))).alias("base"),
        F.array_sort(F.collect_set(F.when(verdict.isNotNull(), span(verdict, "value_begin")))).alias("added"),
    )
    none = F.array().cast(spans.schema["base"].dataType)
    whole = rows.select("doc_id", ROW).join(spans.hint("merge"), ROW, "left")
    base, added = F.coalesce("base", none), F.coalesce("added", none)
    return whole.select(
        "doc_id", *[F.coalesce(f"n_{kind}", F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        base.alias("base"), F.array_sort(F.concat(base, added)).alias("all"),
    )


def shown(spans: str) -> Column:
    """Spans as text: kind:begin:end, joined by commas."""
    each = lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, each), ",")
