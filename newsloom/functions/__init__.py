from .text import (
    any_word, keep_letters, lower_case, moment, settle, shape_of, strip_punctuation, white_split,
    word_count,
)

__all__ = [
    "any_word", "keep_letters", "lower_case", "moment", "settle", "shape_of", "strip_punctuation",
    "white_split", "word_count",
]
