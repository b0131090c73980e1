"""Stored arrivals replayed to a stream in stages, with a restart after each.

A table that numbers its arrivals is cut into stretches of equal span. Each becomes visible to the stream's source in turn, and
the query is started anew on the same checkpoint: state, watermark and the log of files read carry over from run to
run, as they do when a job is stopped and started. Within a stage all rows are one micro-batch, so what a stage's
rows are judged by is the watermark that the stages before it left behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stage_bounds(df: DataFrame, position: str, stages: int) -> list[tuple[int, int]]:
    """First position of each of `stages` stretches of equal span, and that behind it. Empty for no positions."""
    low, high = df.agg(F.min(position), F.max(position)).first()
    if low is None:
        return []
    span = -(-(high - low + 1) // stages)
    return [(low + k * span, low + (k + 1) * span) for k in range(stages)]


def run_in_stages(
    df: DataFrame, position: str, stages: int, folder: str, start: Callable[[DataFrame], StreamingQuery]
) -> list[StreamingQuery]:
    """Feed `df` to the query that `start` makes of a stream, stage by stage; returns the finished queries.

    `start` must use the same checkpoint each time and process what is there (`every=None`). Rows without a
    position are in no stage. A stage is written as a whole before a query sees it.
    """
    spark = df.sparkSession
    done = []
    for k, (first, behind) in enumerate(stage_bounds(df, position, stages)):
        part = df.filter((F.col(position) >= first) & (F.col(position) < behind))
        part.write.parquet(f"{folder}/stage-{k:04d}")
        query = start(spark.readStream.schema(df.schema).parquet(f"{folder}/stage-*"))
        query.awaitTermination()
        done.append(query)
    return done
