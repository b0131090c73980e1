"""Behaviour log -> page views -> sliding counts per item -> best items per window -> report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windrow import constants as c
from windrow.operators.counts import sliding_count
from windrow.operators.event_time import only, with_event_time
from windrow.operators.topn import render_report, top_n_per_window
from windrow.session import state_in_rocksdb
from windrow.streaming.queries import BatchSink, batch_folder_sink, start_files, start_top_n
from windrow.streaming.timers import top_n_by_timer


def page_views(behavior: DataFrame, predicate: Column | None = None, *, delay: str = "0 seconds") -> DataFrame:
    """The page views of a behaviour log with their event time (`timestamp` is in seconds)."""
    predicate = F.col("behavior") == c.PAGE_VIEW if predicate is None else predicate
    return only(with_event_time(behavior, "timestamp", "s", delay=delay), predicate)


def item_window_counts(
    views: DataFrame,
    *,
    size: str = c.HOT_ITEMS_WINDOW,
    slide: str = c.HOT_ITEMS_SLIDE,
    item: str = "itemId",
) -> DataFrame:
    """`itemId, window_end, view_count` for every item and sliding window with a view."""
    return sliding_count(views, item, size, slide, name="view_count").select(item, "window_end", "view_count")


def hot_items(views: DataFrame, n: int = c.HOT_ITEMS_TOP, **windows) -> DataFrame:
    """The `n` most viewed items per window, ranked from 1. Bounded input."""
    return top_n_per_window(item_window_counts(views, **windows), n)


def hot_items_report(views: DataFrame, n: int = c.HOT_ITEMS_TOP, *, zone: str = "UTC", **windows) -> DataFrame:
    """One text per window on its most viewed items. Bounded input."""
    return render_report(hot_items(views, n, **windows), zone=zone)


def report_sink(path: str | None = None, *, zone: str = "UTC") -> BatchSink:
    """Turn ranked rows into reports; store them below `path`, or print them without one.

    Printing fetches one short text per window that the micro-batch closed.
    """
    store = batch_folder_sink(path) if path else None

    def deliver(top: DataFrame, batch_id: int) -> None:
        reports = render_report(top, zone=zone)
        if store:
            store(reports, batch_id)
        else:
            for row in reports.orderBy("window_end").toLocalIterator():
                print(row.report, end="")

    return deliver


def start_hot_items_by_timer(
    views: DataFrame, path: str, *, checkpoint: str, n: int = c.HOT_ITEMS_TOP, every: str | None = None, **windows
) -> StreamingQuery:
    """The same ranking from list state and a timer; Spark's own file sink stores the ranked rows, each once."""
    top = top_n_by_timer(item_window_counts(views, **windows), n)
    with state_in_rocksdb(views.sparkSession):
        return start_files(top, path, checkpoint=checkpoint, every=every)


def start_hot_items(
    views: DataFrame,
    sinks: Sequence[BatchSink],
    *,
    checkpoint: str,
    n: int = c.HOT_ITEMS_TOP,
    every: str | None = None,
    **windows,
) -> StreamingQuery:
    """Rank windows as they close; `sinks` get the ranked rows of each micro-batch."""
    return start_top_n(item_window_counts(views, **windows), n, sinks, checkpoint=checkpoint, every=every)
