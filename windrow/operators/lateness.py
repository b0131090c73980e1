"""Which records came too late? Exact, record by record, for a stored arrival order.

A stream's watermark moves between micro-batches. Here it moves after every record: it is the
largest event time among the records that arrived earlier (at least 0), and a record is late when
the last millisecond of its window is not beyond it. Both functions replay that rule on stored
data. `position` is a BIGINT column that numbers the arrivals without duplicates, such as an
offset; `with_arrival_position` makes one from any sort order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions.clock import duration_micros, floor_to
from windrow.operators.event_time import EVENT_TIME
from windrow.operators.ordering import running_before
from windrow.operators.small_side import fits_broadcast, stored

_WINDOW_BLOCKS = (1 << 12,)


def punctuated_watermark(
    df: DataFrame,
    position: str,
    *,
    time: str = EVENT_TIME,
    by: Sequence[str] = (),
    blocks: Sequence[int] | None = None,
) -> DataFrame:
    """Add `watermark_before` (null for the first record) and `watermark_after`, in epoch ms.

    With `by`, each of its values (a source partition, say) has a watermark of its own.
    """
    timed = df.withColumn("_ms", F.greatest(F.unix_millis(time), F.lit(0)))
    replayed = running_before(timed, position, "_ms", "max", name="watermark_before", by=by, blocks=blocks)
    return replayed.withColumn("watermark_after", F.greatest("watermark_before", "_ms")).drop("_ms")


def late_audit(
    df: DataFrame,
    position: str,
    size: str,
    *,
    time: str = EVENT_TIME,
    by: Sequence[str] = (),
) -> DataFrame:
    """Add `window_start, window_end` (tumbling, `size`) and `is_late` to every record.

    No ordering of the records is needed. A window is closed by the first arrival whose time
    reaches its last millisecond: that is any record of a later window, or one in that very
    millisecond. So one grouped minimum of positions per window, and a running minimum along the
    (few) windows, give the position at which each window closed; records behind it are late.

    The minima per window are computed and stored when this is called; their number then decides
    whether they are broadcast, in which case the records are not shuffled at all.
    """
    if df.isStreaming:
        raise ValueError("the audit replays stored arrivals; a stream drops late records in window_release")
    by = list(by)
    size_ms = duration_micros(size) // 1000
    if size_ms * 1000 != duration_micros(size):
        raise ValueError("windows are whole milliseconds long")
    ms = F.unix_millis(time)
    rows = df.withColumn("_start", floor_to(ms, size_ms))
    # windows before 1970 are closed by any arrival, and so share one entry
    rows = rows.withColumn("_end", F.greatest(F.col("_start") + size_ms, F.lit(0)))

    reaches_end = F.greatest(ms, F.lit(0)) >= F.col("_end") - 1
    closers = (
        rows.groupBy(*by, "_end")
        .agg(
            F.min(position).alias("_first"),
            F.min(F.when(reaches_end, F.col(position))).alias("_first_at_end"),
        )
        # later windows first
        .withColumn("_rank", F.expr(f"-(_end div {size_ms})"))
    )
    closers = stored(closers)  # read more than once below
    small = fits_broadcast(closers)
    closed = running_before(closers, "_rank", "_first", "min", name="_first_beyond", by=by, blocks=_WINDOW_BLOCKS)
    keys = [*by, "_end"]
    closed = closed.select(
        *(F.col(k).alias(f"_closed_{k}") for k in keys),
        F.least("_first_at_end", "_first_beyond").alias("_closed_at"),
    )
    audited = rows.join(F.broadcast(closed) if small else closed, on=[F.col(k).eqNullSafe(F.col(f"_closed_{k}")) for k in keys], how="left")
    return audited.select(
        *df.columns,
        F.timestamp_millis("_start").alias("window_start"),
        F.timestamp_millis(F.col("_start") + size_ms).alias("window_end"),
        F.coalesce(F.col("_closed_at") < F.col(position), F.lit(False)).alias("is_late"),
    )


def on_time_records(df: DataFrame, position: str, size: str, **more) -> DataFrame:
    """The records a window buffer would let through: those that are not late.

    A record without a time belongs to no window and does not come out, as in `window_release`; it moves the
    watermark no further than 0, as in `punctuated_watermark`.
    """
    audited = late_audit(df, position, size, **more)
    return audited.filter(~F.col("is_late") & F.col("window_end").isNotNull()).drop("is_late")
