"""Lemmas of words that no lexicon lists, by suffix edits learned from one.

Each (token, lemma) pair tells an edit: how many characters to take off the end and what to put there.
Edits are counted by the ending they were seen after, and each ending keeps its most frequent one. A word
takes the edit of its longest known ending. Learning and looking up are grouped counts and joins over the
lexicon and the vocabulary, never over the tokens of a corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .lexicon import lookup, normalize_lexicon

LONGEST = 5


def _common(a, b) -> Column:
    """How many characters two texts have in common from the beginning."""
    least = F.least(F.length(a), F.length(b))
    places = F.when(least > 0, F.sequence(F.lit(1), least)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(places, lambda n: F.left(a, n) == F.left(b, n)))


def _endings(token, least, longest: int) -> Column:
    """The endings of a text from `least` to `longest` characters, the empty one too; the whole text is none."""
    sizes = F.filter(F.array(*map(F.lit, range(longest + 1))), lambda n: (n >= least) & (n < F.length(token)))
    return F.transform(sizes, lambda n: F.right(token, n))


def train_lemma_rules(lexicon: DataFrame, longest: int = LONGEST, least_count: int = 2) -> DataFrame:
    """(ending, strip, add): for each ending that `least_count` tokens of a (token, lemma) lexicon share, the
    edit most of them have; of equally frequent ones the shorter, then the first in the alphabet."""
    pairs = normalize_lexicon(lexicon, "lemma").withColumn("same", _common(F.col("token"), F.col("lemma")))
    strip = F.length("token") - F.col("same")
    edits = pairs.select("token", strip.alias("strip"), F.expr("substring(lemma, same + 1)").alias("add"))
    seen = edits.select(F.explode(_endings(F.col("token"), F.col("strip"), longest)).alias("ending"), "strip", "add")
    counted = seen.groupBy("ending", "strip", "add").agg(F.count("*").alias("n"))
    best = F.min_by(F.struct("strip", "add"), F.struct(-F.col("n"), "strip", "add"))
    kept = counted.groupBy("ending").agg(best.alias("edit"), F.sum("n").alias("n")).where(F.col("n") >= least_count)
    return kept.select("ending", "edit.*")


def guess_lemmas(words: DataFrame, rules: DataFrame, known: DataFrame | None = None, longest: int = LONGEST, **lookup_args) -> DataFrame:
    """(token, lemma) of the distinct words of a `token` column that a rule applies to, without those that the
    lexicon `known` lists: a lexicon of its own, for `lemmatize` and `lemma_arrays` with the listed one."""
    new = words.select("token").where("token is not null").distinct()
    if known is not None:
        listed = normalize_lexicon(known, "lemma").select("token")
        new = new.join(listed, "token", "left_anti")
    rows = new.select("token", F.explode(_endings(F.col("token"), F.lit(0), longest)).alias("ending"))
    found = lookup(rows, rules, "ending", "inner", **lookup_args).where(F.col("strip") <= F.length("token"))
    edit = F.max_by(F.struct("strip", "add"), F.length("ending"))
    chosen = found.groupBy("token").agg(edit.alias("edit"))
    return chosen.select("token", F.concat(F.expr("left(token, length(token) - edit.strip)"), "edit.add").alias("lemma"))
