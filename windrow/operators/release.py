"""Hold records until their window closes, then let them go unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions.clock import duration_micros, floor_to, interval_text
from windrow.operators.event_time import EVENT_TIME

_CHUNK = 1 << 10


def window_release(df: DataFrame, size: str, *, time: str = EVENT_TIME) -> DataFrame:
    """Add `window_start, window_end` of the tumbling window each record belongs to.

    Bounded input: every window closes at the end of input, so this is a projection. Records
    without a time belong to no window and do not come out.

    Stream: records appear when the watermark passes their window's end, and records that arrive
    after that are dropped. The held records are grouped by window *and all their fields* with a
    count of equal copies, not collected per key: the records of a busy key spread over all
    partitions, and any number of equal copies is one row of state. (Zeros lose their sign, as in
    any Spark grouping; map columns cannot be grouped.)
    """
    size_us = duration_micros(size)
    if not df.isStreaming:
        start = floor_to(F.unix_micros(time), size_us)
        return df.filter(F.col(time).isNotNull()).select(
            "*",
            F.timestamp_micros(start).alias("window_start"),
            F.timestamp_micros(start + size_us).alias("window_end"),
        )
    others = [c for c in df.columns if c != time]
    held = df.groupBy(
        F.window(time, interval_text(size_us)).alias("_window"),
        F.unix_micros(time).alias("_micros"),  # a number, so that only the window carries the watermark
        *others,
    ).agg(F.count(F.lit(1)).alias("_copies"))
    fields = [F.timestamp_micros("_micros").alias(c) if c == time else F.col(c) for c in df.columns]
    released = held.select(
        *fields,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        "_copies",
    )
    return _repeated(released, "_copies")


def _repeated(df: DataFrame, copies: str) -> DataFrame:
    """Each row `copies` times, through two small arrays instead of one as long as the number."""
    columns = [c for c in df.columns if c != copies]
    chunks = df.select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1, F.lit(_CHUNK))).alias("_from")
    )
    size = F.least(F.lit(_CHUNK).cast("bigint"), F.col(copies) - F.col("_from"))
    return chunks.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_copy")).drop("_copy")
