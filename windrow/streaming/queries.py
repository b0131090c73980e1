"""Streaming queries over the operators.

`checkpoint` is the folder a query recovers from: source progress and operator state. A query
restarted on the same folder goes on where it stopped. `every` is the pause between micro-batches
(and so between points of recovery); None processes what is there and stops.

Sinks that Spark does not commit itself (`foreachBatch`) write each micro-batch to a folder
`batch_id=<n>` of its own in overwrite mode, so a micro-batch that is run again after a failure
replaces its first attempt.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from windrow.operators.topn import top_n_per_window
from windrow.sinks.buckets import BUCKET, encoded
from windrow.sinks.commits import commit_batch

BatchSink = Callable[[DataFrame, int], None]


def _started(writer: DataStreamWriter, checkpoint: str, every: str | None, name: str | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start()


def start_bucketed(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    checkpoint: str,
    every: str | None = None,
    max_records_per_file: int = 0,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream with a `bucket` column to one folder per bucket, exactly once.

    A file is closed with each micro-batch, so `every` is the roll interval;
    `max_records_per_file` bounds a file within one.
    """
    writer = (
        encoded(df, fmt)
        .writeStream.format(fmt)
        .outputMode("append")
        .partitionBy(BUCKET)
        .option("path", path)
        .option("maxRecordsPerFile", max_records_per_file)
    )
    return _started(writer, checkpoint, every, name)


def start_files(
    df: DataFrame, path: str, fmt: str = "parquet", *, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append the rows of a stream to files below `path`, exactly once."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    return _started(writer, checkpoint, every, name)


def start_console(
    df: DataFrame,
    *,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Print every row of every micro-batch."""
    writer = df.writeStream.foreachBatch(print_sink()).outputMode(mode)
    return _started(writer, checkpoint, every, name)


def batch_folder_sink(path: str, fmt: str = "parquet") -> BatchSink:
    """Write a micro-batch to `path/batch_id=<n>`, below it by bucket where the rows have one."""

    def write(batch: DataFrame, batch_id: int) -> None:
        bucketed = BUCKET in batch.columns
        writer = (encoded(batch, fmt) if bucketed else batch).write.format(fmt).mode("overwrite")
        if bucketed:
            writer = writer.partitionBy(BUCKET)
        writer.save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def print_sink() -> BatchSink:
    """Print all rows, fetched one partition at a time, below a line of the columns' names."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        print("\t".join(batch.columns))
        for row in batch.toLocalIterator():
            print("\t".join(map(str, row)))

    return show


def _deliver(batch: DataFrame, batch_id: int, sinks: Sequence[BatchSink], shared: bool) -> None:
    """Hand a micro-batch to its sinks; a `shared` one is kept, so that it is computed only once."""
    if shared:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for sink in sinks:
            sink(batch, batch_id)
    finally:
        if shared:
            batch.unpersist()


def fan_out(
    df: DataFrame,
    sinks: Sequence[BatchSink],
    *,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    name: str | None = None,
    commits: str | None = None,
) -> StreamingQuery:
    """Send one stream to several sinks, computing every micro-batch once.

    With `commits`, a folder, a micro-batch is marked there when all sinks have it. What `read_committed` shows of
    them then has each micro-batch in all sinks or in none, also while the query runs and after it was
    killed between two sinks; a repeated micro-batch replaces its first attempt.

    Independent queries with checkpoints of their own do too, at the price of reading the source
    and keeping the state once per sink.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        _deliver(batch, batch_id, sinks, shared=len(sinks) > 1)
        if commits:
            commit_batch(batch.sparkSession, commits, batch_id)

    return _started(df.writeStream.outputMode(mode).foreachBatch(deliver), checkpoint, every, name)


def start_top_n(
    counts: DataFrame,
    n: int,
    sinks: Sequence[BatchSink],
    *,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    **ranking,
) -> StreamingQuery:
    """Rank the windows of a stream of windowed counts as they close.

    In append mode a window's counts leave the aggregation once, all in the micro-batch in which
    the watermark passes its end. A micro-batch therefore holds whole windows, and ranking it as
    bounded data is exact. The state is one count per item and open window; no window is gathered
    in one place.
    """

    def ranked(batch: DataFrame, batch_id: int) -> None:
        top = top_n_per_window(batch, n, **ranking)
        _deliver(top, batch_id, sinks, shared=True)  # small, and a sink may read it more than once

    return _started(counts.writeStream.outputMode("append").foreachBatch(ranked), checkpoint, every, name)


def start_running_totals(
    totals: DataFrame,
    path: str,
    *,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Log every change of a running count below `path`; `latest_totals` reads the present state."""
    return fan_out(totals, [batch_folder_sink(path)], checkpoint=checkpoint, mode="update", every=every, name=name)


def latest_totals(spark: SparkSession, path: str, keys: Sequence[str], value: str = "cnt") -> DataFrame:
    """The last total of each key from a log of changes."""
    return (
        spark.read.parquet(path)
        .groupBy(*keys)
        .agg(F.max_by(value, "batch_id").alias(value))
    )
