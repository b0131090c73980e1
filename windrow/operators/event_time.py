"""Event time and watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions import clock

EVENT_TIME = "event_time"


def with_event_time(
    df: DataFrame,
    column: str | Column,
    unit: str,
    *,
    delay: str = "0 seconds",
    name: str = EVENT_TIME,
) -> DataFrame:
    """Add the event-time column `name` and declare how far out of order it may be.

    `unit`: `s`, `ms`, `us` for epoch numbers, `ts` for a timestamp. With `delay` zero the
    watermark is the largest time seen, taken at the end of each micro-batch; on batch input the
    watermark has no effect.
    """
    column = F.col(column) if isinstance(column, str) else column
    return df.withColumn(name, clock.event_time(column, unit)).withWatermark(name, delay)


def only(df: DataFrame, predicate: Column) -> DataFrame:
    """Keep rows for which the predicate is true; null counts as not true.

    On a stream every record moves the watermark, also those that are not kept. Spark would move a plain filter below the
    watermark, so that dropped records could not move it; a column that a generator makes is known only above. On a table
    nothing is gained by that, and the filter may go down to the scan.
    """
    if not df.isStreaming:
        return df.filter(predicate)
    judged = df.select("*", F.explode(F.array(F.coalesce(predicate, F.lit(False)))).alias("_kept"))
    return judged.filter("_kept").drop("_kept")
