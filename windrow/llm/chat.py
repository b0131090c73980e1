"""Conversations as training texts, by Spark expressions only.

The turns of a conversation are collected as structs and sorted by turn, then role, then text, so that
ties and repeated rows have an order too and each row stays a turn. Adjacent turns of one role
become one message, whose role is written once and whose texts are parted by a mark:

    <turn>user
    first text<part/>second text</turn>
    <turn>assistant
    ...

Inside texts and roles a backslash is doubled, the `<` of a mark becomes `\\l`, and in roles a line feed
becomes `\\n`. An escaped text so never holds a mark, and unescaping gives the text back to the letter.

The loss mask is an array of spans over the formatted text, one for each text of a role that is
trained on, in code points with the end exclusive; marks, roles and line feeds are never in it.

Null texts and roles are empty; null turn numbers come first; rows with a null conversation id are one
conversation with a null id. Texts are never cut. A table without rows gives none. Columns other
than the four named are not read. A conversation is one row, as a document is: the memory of a task is bounded
by its longest conversations, and their texts cross the exchange once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.columns import cut, running_sums
from windrow.llm.quality import let

# the template
OPEN, PART, CLOSE = "<turn>", "<part/>", "</turn>\n"
MARK = "<(?=/?turn>|part/>)"
LEARNED = ("assistant",)


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, MARK, r"\\l")


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """What `escaped` and `escaped_role` were given: pieces between doubled backslashes hold the single ones."""

    def plain(piece: Column) -> Column:
        return F.replace(F.replace(piece, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n"))

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def _messages(turns: Column) -> Column:
    """Runs of turns of one role: `role`, `texts`."""

    def begins(i: Column) -> Column:
        return (i == 0) | (F.get(turns, i - 1)["role"] != F.get(turns, i)["role"])

    def run(starts: Column, at: Column, k: Column) -> Column:
        stop = F.coalesce(F.get(starts, k + 1), F.size(turns))
        texts = F.transform(F.slice(turns, at + 1, stop - at), lambda t: t["text"])
        return F.struct(F.get(turns, at)["role"].alias("role"), texts.alias("texts"))

    starts = F.filter(F.sequence(F.lit(0), F.size(turns) - 1), begins)
    return let(starts, lambda s: F.transform(s, lambda at, k: run(s, at, k)))


def _pieces(message: Column, learned: tuple[str, ...]) -> Column:
    """The message in pieces: `text`, and whether the loss counts it."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no, yes = F.lit(False), message["role"].isin(*learned)
    head = piece(F.concat(F.lit(OPEN), escaped_role(message["role"]), F.lit("\n")), no)
    body = F.transform(
        message["texts"], lambda t, i: F.array(piece(F.when(i > 0, PART).otherwise(""), no), piece(escaped(t), yes))
    )
    return F.concat(F.array(head), F.flatten(body), F.array(piece(F.lit(CLOSE), no)))


def _formatted(pieces: Column) -> Column:
    sizes = F.transform(pieces, lambda p: F.length(p["text"]))

    def spans(ends: Column) -> Column:
        every = F.transform(
            pieces, lambda p, i: F.struct((F.get(ends, i) - F.length(p["text"])).alias("start"), F.get(ends, i).alias("stop"), p["loss"].alias("loss"))
        )
        return F.transform(F.filter(every, lambda s: s["loss"]), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))

    text = F.array_join(F.transform(pieces, lambda p: p["text"]), "")
    return F.struct(text.alias("formatted"), let(running_sums(sizes), spans).alias("loss"))


def format_conversations(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learned: tuple[str, ...] = LEARNED
) -> DataFrame:
    """`key`, `formatted` and `loss` (array of `start`, `stop`) of every conversation."""
    one = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    gathered = rows.groupBy(F.col(key).alias("_chat_id")).agg(F.sort_array(F.collect_list(one)).alias("_chat_turns"))
    pieces = let(F.col("_chat_turns"), lambda t: F.flatten(F.transform(_messages(t), lambda m: _pieces(m, learned))))
    # through a generator, which Spark does not work out again for each column that reads it
    return gathered.select(F.col("_chat_id").alias(key), F.inline(F.array(let(pieces, _formatted))))


def turns_of(formatted: Column) -> Column:
    """The turns that a formatted text holds: array of `role`, `text`."""

    def turns(message: Column) -> Column:
        line = F.instr(message, F.lit("\n"))
        role = unescaped(F.substring(message, F.lit(len(OPEN) + 1), line - len(OPEN) - 1))
        texts = F.split(F.substring(message, line + 1, F.length(message)), PART)
        return let(role, lambda r: F.transform(texts, lambda t: F.struct(r.alias("role"), unescaped(t).alias("text"))))

    messages = F.split(formatted, CLOSE)
    return F.flatten(F.transform(let(messages, lambda m: F.slice(m, 1, F.size(m) - 1)), turns))


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, in order, without escapes."""
    return F.array_join(F.transform(cut(formatted, loss), unescaped), "")
