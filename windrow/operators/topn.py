"""The N best per window, and the text report on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from windrow import constants as c
from windrow.functions.clock import jdbc_timestamp_text
from windrow.operators.ordering import with_arrival_position
from windrow.operators.small_side import broadcast_if_small

_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
_ROW_BITS = 33  # of a number by monotonically_increasing_id; those above are the partition's


def top_n_per_window(
    counts: DataFrame,
    n: int,
    *,
    window: str = "window_end",
    score: str = "view_count",
    item: str = "itemId",
    rank: str = "rank",
) -> DataFrame:
    """The `n` rows with the highest `score` in each window, ranked from 1; ties by smaller item.

    Windows with fewer rows give what they have. Spark cuts every map task's rows to `n` per
    window before the exchange, so no task receives a whole window. It does so only up to a
    configured `n`; above that, ranks are read off one sort by ranges, see `_ranked_by_ranges`.

    Bounded input only; for streams see `windrow.streaming.start_top_n`, which applies this to
    the windows that a micro-batch has closed.
    """
    if counts.isStreaming:
        raise ValueError("ranking needs bounded input: use windrow.streaming.start_top_n")
    best_first = [F.col(score).desc(), F.col(item).asc()]
    if n > int(counts.sparkSession.conf.get(_GROUP_LIMIT, "1000")):
        return _ranked_by_ranges(counts, n, window, best_first, rank)
    ranked = counts.withColumn(rank, F.row_number().over(W.partitionBy(window).orderBy(*best_first)))
    return ranked.filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("bigint"))


def _ranked_by_ranges(counts: DataFrame, n: int, window: str, best_first: list[Column], rank: str) -> DataFrame:
    """The same for any `n`, computed and stored when called.

    Rows are sorted by window and rank over all tasks, so that a large window, or one whose rows are all equal in score, lies
    in many ranges. A row's rank is its place in the range's stretch of its window, and the lengths of the window's stretches
    in earlier ranges. There is a stretch for each window and range, at most as many as windows and ranges together; they
    are broadcast if they are few. Ranges behind the first `n` of a window are passed over.
    """
    sorted_rows = with_arrival_position(counts, F.col(window), *best_first, name="_position")
    sorted_rows = sorted_rows.withColumn("_range", F.shiftright("_position", _ROW_BITS))
    stretches = sorted_rows.groupBy(F.col(window).alias("_window"), F.col("_range").alias("_at")).agg(
        F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_length")
    )
    earlier = W.partitionBy("_window").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    stretches = stretches.withColumn("_before", F.coalesce(F.sum("_length").over(earlier), F.lit(0))).drop("_length")
    needed = broadcast_if_small(stretches.filter(F.col("_before") < n))
    met = sorted_rows.join(needed, (F.col("_range") == F.col("_at")) & F.col(window).eqNullSafe(F.col("_window")))
    ranked = met.withColumn(rank, F.col("_before") + F.col("_position") - F.col("_first") + 1)
    return ranked.filter(F.col(rank) <= n).select(*counts.columns, rank)


def render_report(
    top: DataFrame,
    *,
    window: str = "window_end",
    score: str = "view_count",
    item: str = "itemId",
    rank: str = "rank",
    zone: str = "UTC",
) -> DataFrame:
    """One text per window from ranked rows: `window, report`. Ranks are shown from 0.

    A report gathers at most N short lines, N being that of the ranking.
    """
    line = F.concat(
        F.lit(c.REPORT_RANK_LABEL),
        (F.col(rank) - 1).cast("string"),
        F.lit(c.REPORT_ITEM_LABEL),
        F.col(item).cast("string"),
        F.lit(c.REPORT_COUNT_LABEL),
        F.col(score).cast("string"),
        F.lit("\n"),
    )
    gathered = top.groupBy(window).agg(
        F.sort_array(F.collect_list(F.struct(F.col(rank).alias("at"), line.alias("line")))).alias("lines")
    )
    return gathered.select(
        window,
        F.concat(
            F.lit(c.REPORT_RULE + "\n" + c.REPORT_TIME_LABEL),
            jdbc_timestamp_text(F.col(window), zone),
            F.lit("\n"),
            F.array_join(F.col("lines.line"), ""),
            F.lit(c.REPORT_RULE + "\n\n"),
        ).alias("report"),
    )
