"""Column expressions over arrays and texts whose cost stays about linear in their length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow.llm.quality import let

BLOCK = 64  # numbers whose sums are listed one by one
CHUNK = 1024  # code points


def _listed(numbers: Column, join: Callable[[Column, Column], Column]) -> Column:
    """What has been joined up to and with each number; the list is copied for each, so it must be short."""
    start = F.struct(F.lit(None).cast("long").alias("now"), F.array().cast("array<long>").alias("all"))

    def add(done: Column, x: Column) -> Column:
        now = F.when(done["now"].isNull(), x.cast("long")).otherwise(join(done["now"], x.cast("long")))
        return F.struct(now.alias("now"), F.concat(done["all"], F.array(now)).alias("all"))

    return F.aggregate(numbers, start, add, lambda done: done["all"])


def _running(numbers: Column, join: Callable[[Column, Column], Column]) -> Column:
    """In blocks, then along the blocks."""

    def blocks(x: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(x) - 1, F.lit(BLOCK)), lambda at: _listed(F.slice(x, at + 1, BLOCK), join))

    def joined(b: Column) -> Column:
        last = _listed(F.transform(b, lambda part: F.element_at(part, -1)), join)

        def onward(part: Column, before: Column) -> Column:
            return F.transform(part, lambda s: F.when(before.isNull(), s).otherwise(join(before, s)))

        return let(last, lambda ends: F.flatten(F.transform(b, lambda part, k: onward(part, F.get(ends, k - 1)))))

    empty = F.array().cast("array<long>")
    return let(numbers, lambda x: F.when(F.size(x) > 0, let(blocks(x), joined)).otherwise(empty))


def running_sums(numbers: Column) -> Column:
    """Sums (BIGINT) up to and with each number of an array without nulls."""
    return _running(numbers, lambda a, b: a + b)


def running_maxima(numbers: Column) -> Column:
    """The largest number (BIGINT) up to and with each of an array without nulls."""
    return _running(numbers, F.greatest)


def cut(text: Column, spans: Column) -> Column:
    """The parts of a text at `spans` (structs with `start` and `stop` in code points, stop exclusive).

    `substring` walks from the start of a text; here it walks a chunk.
    """

    def part(chunks: Column, s: Column) -> Column:
        first, last = F.floor(s["start"] / CHUNK).cast("int"), F.floor((s["stop"] - 1) / CHUNK).cast("int")
        at = (s["start"] - first * CHUNK).cast("int")
        size = (s["stop"] - s["start"]).cast("int")
        rest = (s["stop"] - last * CHUNK).cast("int")
        inner = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        long = F.concat(F.substring(F.get(chunks, first), at + 1, F.lit(CHUNK)), inner, F.substring(F.get(chunks, last), F.lit(1), rest))
        return F.when(size <= 0, "").when(first == last, F.substring(F.get(chunks, first), at + 1, size)).otherwise(long)

    chunks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CHUNK), F.lit(0))
    return let(chunks, lambda c: F.transform(spans, lambda s: part(c, s)))
