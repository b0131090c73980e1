"""Counts per key: in tumbling or sliding windows, or running for ever."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.clock import duration_micros, floor_to, interval_text
from windrow.operators.event_time import EVENT_TIME


def windowed_count(
    df: DataFrame,
    keys: str | Sequence[str],
    size: str,
    slide: str | None = None,
    *,
    time: str = EVENT_TIME,
    value: str | None = None,
    name: str = "cnt",
) -> DataFrame:
    """Count rows (or sum `value`) per key and window: `keys, window_start, window_end, name`.

    Windows start at multiples of the slide and are half open; rows without a time are in none.
    Tumbling when `slide` is None. On a stream, a window comes out when the watermark reaches its
    end.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    size_us = duration_micros(size)
    slide_us = duration_micros(slide) if slide else size_us
    total = F.count(F.lit(1)) if value is None else F.sum(value)

    if df.isStreaming:
        window = F.window(time, interval_text(size_us), interval_text(slide_us))
        return (
            df.groupBy(*keys, window.alias("_window"))
            .agg(total.alias(name))
            .select(
                *keys,
                F.col("_window.start").alias("window_start"),
                F.col("_window.end").alias("window_end"),
                name,
            )
        )
    ends = _counted_panes(df, keys, size_us, slide_us, time, total, name)
    return ends.select(
        *keys,
        F.timestamp_micros(F.col("_end") - size_us).alias("window_start"),
        F.timestamp_micros("_end").alias("window_end"),
        name,
    )


def _counted_panes(
    df: DataFrame, keys: list[str], size_us: int, slide_us: int, time: str, total: Column, name: str
) -> DataFrame:
    """Bounded input: aggregate once per pane, then add panes up to windows.

    A pane is the longest stretch that no window boundary cuts (one slide, where the slide divides
    the size). Each row is counted in one pane, not in size / slide windows, so the exchange of the
    raw data carries at most one partial count per key and pane and task; only finished pane counts
    are multiplied. Panes are plain numbers, which hash and compare faster than window structs.

    A stream cannot do this: there, a record may be late for one of its windows and not for others.
    """
    pane_us = math.gcd(size_us, slide_us)
    pane = floor_to(F.unix_micros(time), pane_us)
    panes = df.filter(F.col(time).isNotNull()).groupBy(*keys, pane.alias("_pane")).agg(total.alias(name))
    if slide_us == size_us:
        return panes.select(*keys, (F.col("_pane") + size_us).alias("_end"), name)
    last_end = floor_to(F.col("_pane"), slide_us) + size_us  # of the latest window that holds the pane
    earlier = F.sequence(F.lit(0).cast("long"), F.lit(size_us - 1).cast("long"), F.lit(slide_us).cast("long"))
    return (
        panes.select(*keys, "_pane", last_end.alias("_last_end"), name, F.explode(earlier).alias("_earlier"))
        .select(*keys, "_pane", (F.col("_last_end") - F.col("_earlier")).alias("_end"), name)
        .filter(F.col("_end") > F.col("_pane"))
        .groupBy(*keys, "_end")
        .agg(F.sum(name).alias(name))
    )


def tumbling_count(df: DataFrame, keys: str | Sequence[str], size: str, **more) -> DataFrame:
    return windowed_count(df, keys, size, **more)


def sliding_count(df: DataFrame, keys: str | Sequence[str], size: str, slide: str, **more) -> DataFrame:
    return windowed_count(df, keys, size, slide, **more)


def running_count(
    df: DataFrame, keys: str | Sequence[str], *, value: str | None = None, name: str = "cnt"
) -> DataFrame:
    """Count rows (or sum `value`) per key over everything seen so far.

    On a stream, write it in update mode: each micro-batch brings the new total of every key it
    touched. The state has one number per key and is never dropped.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    total = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.groupBy(*keys).agg(total.alias(name))
