"""Parsing of JSON text messages into records with defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow.constants import NULL_BEFORE_COMMA, QUOTED_NULL_BEFORE_COMMA

SENTINEL = "_end_of_message"

_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
    "allowUnquotedControlChars": "true",
    "allowNumericLeadingZeros": "true",
}


def quote_nulls(message: Column) -> Column:
    """Turn `:null,` into `:"null",` anywhere in the text, inside string values too."""
    return F.replace(message, F.lit(NULL_BEFORE_COMMA), F.lit(QUOTED_NULL_BEFORE_COMMA))


# a JSON number with a fraction or an exponent, which a parser would print in its own way
_LITERAL = r"-?[0-9]++(?:\.[0-9]++(?:[eE][+-]?[0-9]++)?|[eE][+-]?[0-9]++)"
_SEEMS_LITERAL = r"[0-9](?:\.[0-9]|[eE][+-]?[0-9])"
_VALUE_END = r"\s*+[,}\]]"
# strings, literals up to what ends them, words, all else: without nested repeats, so that long messages need no deep stack
_PIECES = "|".join(
    ['"[^"]*+"', "'[^']*+'", _LITERAL + _VALUE_END, r"[A-Za-z0-9_$.+-]++", r"""[^"'A-Za-z0-9_$.+-]++""", "[\"']"]
)


def message_mark(message: Column) -> Column:
    """A text that a message cannot hold except on purpose: its own hash."""
    return F.xxhash64(message).cast("string")


def seems_literal(message: Column) -> Column:
    """May the message hold a number with a fraction or an exponent? Most do not and are left alone."""
    return F.coalesce(F.regexp_instr(message, F.lit(_SEEMS_LITERAL)) > 0, F.lit(False))


def mark_literals(message: Column, mark: Column) -> Column:
    """The message with its numbers of fraction or exponent as marked strings, at any depth; `written` takes the marks off.

    Escaped quotes and backslashes are put as code points first, so that a quote always begins or ends a string. The message
    is cut into pieces, each is looked at by itself, and they are joined: work is in proportion to the length.
    """
    text = message
    for pair, code in (("\\\\", "\\u005c"), ('\\"', "\\u0022"), ("\\'", "\\u0027")):
        text = F.replace(text, F.lit(pair), F.lit(code))
    marked = F.concat(F.lit('"'), mark, F.lit("<$1>"), mark, F.lit('"$2'))
    whole = F.lit(rf"\A({_LITERAL})({_VALUE_END})\z")
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    return F.array_join(F.transform(pieces, lambda piece: F.regexp_replace(piece, whole, marked)), "")


def written(value: Column, mark: Column) -> Column:
    """A field of a message that went through `mark_literals`, its numbers as they were written."""
    for quote in ('"', ""):  # within an object or array the parser prints the quotes too
        value = F.replace(value, F.concat(F.lit(quote), mark, F.lit("<")), F.lit(""))
        value = F.replace(value, F.concat(F.lit(">"), mark, F.lit(quote)), F.lit(""))
    return value


def parse_object(message: Column, keys: Mapping[str, tuple[str, str]], mark: Column) -> Column:
    """The keys of exactly one JSON object, all as text, in an array `[object, sentinel]`.

    A JSON parser stops at the end of the first value and would let text behind it pass. The
    message is therefore parsed as the first element of an array whose second element is ours and
    holds a hash of the message. A message that closes the array itself and brings a second element
    of its own would have to hold its own hash, which is `mark`.
    """
    wanted = dict.fromkeys([*(key for key, _ in keys.values()), SENTINEL])
    schema = "array<struct<" + ",".join(f"`{key}`:string" for key in wanted) + ">>"
    end = F.concat(F.lit(f',{{"{SENTINEL}":"'), mark, F.lit('"}]'))
    return F.from_json(F.concat(F.lit("["), message, end), schema, _JSON_OPTIONS)


def is_one_object(parsed: Column, message: Column) -> Column:
    """`message` is the text that the mark given to `parse_object` was made of."""
    ours = parsed[1][SENTINEL] == message_mark(message)
    return F.coalesce((F.size(parsed) == 2) & parsed[0].isNotNull() & ours, F.lit(False))


def field_or_default(parsed: Column, key: str, default: str) -> Column:
    return F.coalesce(parsed[0][key], F.lit(default))
