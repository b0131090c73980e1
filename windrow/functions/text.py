"""Tokenizer columns that split the way `java.lang.String.split(regex)` does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow.constants import LINE_SEPARATOR, WHITESPACE

_BLANKS = " \t\n\x0b\f\r"  # what \s matches


def java_split(text: Column, pattern: str) -> Column:
    """Split by any regular expression, dropping trailing empty pieces.

    Spark keeps trailing empty strings; Java drops them, unless the pattern matched nowhere, in
    which case the text itself is the only piece (so `''` gives `['']`).
    """
    pieces = F.split(text, pattern)
    last_filled = F.array_max(
        F.transform(pieces, lambda piece, at: F.when(F.length(piece) > 0, at + 1).otherwise(F.lit(0)))
    )
    return F.when(F.size(pieces) == 1, pieces).otherwise(F.slice(pieces, F.lit(1), last_filled))


def whitespace_pieces(text: Column) -> Column:
    r"""`java_split(text, r"\s")` without per-piece functions: trailing blanks are cut beforehand.

    Blanks side by side leave empty pieces between them, and a leading blank leaves one in front.
    """
    trimmed = F.rtrim(text, F.lit(_BLANKS))
    return (
        F.when(F.length(text) == 0, F.array(F.lit("")))
        .when(F.length(trimmed) == 0, F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, WHITESPACE))
    )


def lowered_pieces(text: Column, pattern: str = LINE_SEPARATOR) -> Column:
    """Lower-case, then split; callers drop the empty pieces, so trailing ones need no care."""
    return F.split(F.lower(text), pattern)
