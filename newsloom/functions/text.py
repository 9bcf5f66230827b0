"""Column functions on text. All are built-ins that stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from string import ascii_lowercase

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import ACCENTED_LETTERS


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(as_of=None) -> Column:
    """`as_of` as a column; the time of the query or micro-batch when it is None."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def lower_case(c) -> Column:
    return F.lower(_column(c))


def strip_punctuation(c) -> Column:
    return F.regexp_replace(_column(c), r"[,\.!?]", "")


def white_split(c) -> Column:
    """Split at runs of ASCII white space; a leading or trailing run leaves an empty word."""
    return F.split(_column(c), r"\s+")


def word_count(c) -> Column:
    return F.size(white_split(c))


def keep_letters(c, letters: str = ascii_lowercase + ACCENTED_LETTERS) -> Column:
    """Lower-case and delete everything but the given letters and white space.

    The letters are listed one by one on purpose: a class of single Latin-1 characters is
    one table lookup per character, while ranges are tested one after the other (8 times
    slower on the test corpus).
    """
    return F.regexp_replace(lower_case(c), f"[^{letters} \\t\\n\\x0B\\f\\r]+", "")


def any_word(lowered, words: Sequence[str], whole_word: bool = False) -> Column:
    """True where one of the words is in the lower-cased text."""
    lowered = _column(lowered)
    if whole_word:
        either = "|".join(re.escape(w) for w in words)
        return lowered.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{either})(?![\p{{L}}\p{{N}}])")
    return reduce(Column.__or__, (lowered.contains(w) for w in words))


def shape_of(token, shapes: Iterable[tuple[str, str]], other: str) -> Column:
    """The value of the first shape (a regex) the token has, else `other`."""
    token = _column(token)
    shapes = list(shapes)
    picked = F.when(token.rlike(shapes[0][0]), shapes[0][1])
    for pattern, value in shapes[1:]:
        picked = picked.when(token.rlike(pattern), value)
    return picked.otherwise(other)


def settle(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is worked out once per row, whatever reads it later.

    A plain column is an expression the optimizer may copy into its readers: into a filter that
    is pushed below it, or into a lambda, where it would run once per array element. A generator
    of one row per row is a boundary neither crosses.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*others, F.inline_outer(F.array(F.struct(value.alias(name)))))
