"""Text to words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.constants import LINE_SEPARATOR, WHITESPACE
from windrow.functions.text import java_split, lowered_pieces, whitespace_pieces


def whitespace_words(df: DataFrame, text: str = "value", *, pattern: str = WHITESPACE, name: str = "word") -> DataFrame:
    """One row per piece of `text` between single blanks, case kept, empty pieces included.

    Replaces the text column by `name`; the other columns stay.
    """
    pieces = whitespace_pieces(F.col(text)) if pattern == WHITESPACE else java_split(F.col(text), pattern)
    return _exploded(df, text, pieces, name)


def line_words(df: DataFrame, text: str = "value", *, pattern: str = LINE_SEPARATOR, name: str = "word") -> DataFrame:
    """One row per non-empty piece of the lower-cased text.

    The default pattern asks for a backslash and capital Ns; lower-cased text has no capital, so
    each message is one word. Pass `NON_WORD` to split at anything but letters, digits and `_`.
    """
    words = _exploded(df, text, lowered_pieces(F.col(text), pattern), name)
    return words.filter(F.length(name) > 0)


def _exploded(df: DataFrame, text: str, pieces, name: str) -> DataFrame:
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(pieces).alias(name))
