"""Raw topic messages -> time-bucketed text files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from windrow import constants as c
from windrow.sinks.buckets import with_bucket, write_bucketed
from windrow.streaming.queries import start_bucketed


def bucketed_lines(
    raw: DataFrame, *, clock: str | None = "timestamp", pattern: str = c.MINUTE_BUCKET, zone: str = c.BUCKET_ZONE
) -> DataFrame:
    """`value, bucket`; the bucket goes by the column `clock`, or by the writer's clock if None."""
    return with_bucket(raw, time=clock, pattern=pattern, zone=zone).select("value", "bucket")


def store_messages(raw: DataFrame, path: str, *, mode: str = "append", gather: bool = True, **bucket) -> None:
    """Bounded input: write every message to the folder of its bucket."""
    write_bucketed(bucketed_lines(raw, **bucket), path, "text", mode=mode, gather=gather)


def start_message_log(
    raw: DataFrame,
    path: str,
    *,
    checkpoint: str,
    every: str | None = c.MESSAGE_LOG_ROLL_INTERVAL,
    max_records_per_file: int = 0,
    **bucket,
) -> StreamingQuery:
    """Append every message to the folder of its minute, a new file each roll interval."""
    return start_bucketed(
        bucketed_lines(raw, **bucket), path, "text", checkpoint=checkpoint, every=every, max_records_per_file=max_records_per_file
    )
