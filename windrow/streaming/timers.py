"""Ranking by keyed list state and an event-time timer.

`start_top_n` ranks the windows that a micro-batch closes as bounded data. This is the same result as an operator with state of
its own: the counts of a window are kept in a list until the watermark passes the window's end by a millisecond; then the
timer ranks them, and the list is cleared. It can be followed by further operators of the same stream, and it holds
counts across restarts, at the price of Python workers and of one task per window when the timer fires.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from windrow.session import let_workers_import

TIMER_DELAY_MS = 1


class WindowRanking(StatefulProcessor):
    """The `n` rows of the highest score of a window, ranked from 1; ties go to the smaller item."""

    def __init__(self, n: int, item: str, score: str, state: StructType):
        self.n, self.item, self.score, self.state = n, item, score, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getListState("counts", self.state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.counts.appendList([(r[self.item], r[self.score]) for r in rows])
        self.handle.registerTimer(key[0] + TIMER_DELAY_MS)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # the list is read once, and no more than n rows of it are held
        best = heapq.nsmallest(self.n, self.counts.get(), key=lambda r: (-r[1], r[0]))
        self.counts.clear()
        return iter([Row(end_ms=key[0], item=r[0], score=r[1], rank=k) for k, r in enumerate(best, 1)])

    def close(self) -> None:
        pass


def top_n_by_timer(
    counts: DataFrame, n: int, *, window: str = "window_end", score: str = "view_count", item: str = "itemId", rank: str = "rank"
) -> DataFrame:
    """`window, item, score, rank` of a stream of windowed counts: rows come out when the watermark is past the window's end.

    The state is a row per item of the windows whose counts are known and whose timer has not fired.
    """
    if not counts.isStreaming:
        raise ValueError("timers need a stream: use top_n_per_window")
    let_workers_import(counts.sparkSession)
    kind = counts.schema[item].dataType
    state = StructType([StructField("item", kind), StructField("score", LongType())])
    output = StructType([StructField("end_ms", LongType()), *state.fields, StructField("rank", LongType())])
    keyed = counts.select(F.unix_millis(window).alias("end_ms"), item, F.col(score).cast("long").alias(score), window)
    ranked = keyed.groupBy("end_ms").transformWithState(
        statefulProcessor=WindowRanking(n, item, score, state), outputStructType=output, outputMode="append", timeMode="eventTime"
    )
    return ranked.select(
        F.timestamp_millis("end_ms").alias(window), F.col("item").alias(item), F.col("score").alias(score), F.col("rank").alias(rank)
    )
