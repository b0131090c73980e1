"""Topic messages -> records -> released per window -> time-bucketed Parquet or text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from windrow import constants as c
from windrow.operators.event_time import EVENT_TIME
from windrow.operators.lateness import on_time_records
from windrow.operators.normalise import (
    PASSING_RECORDS,
    STATE_EVENTS,
    RecordSpec,
    good_records,
    normalise,
    rejects,
)
from windrow.operators.release import window_release
from windrow.sinks.buckets import with_bucket, write_bucketed
from windrow.sinks.commits import read_committed
from windrow.streaming.queries import BatchSink, batch_folder_sink, fan_out, print_sink, start_bucketed


def released_records(
    raw: DataFrame,
    spec: RecordSpec,
    size: str,
    *,
    delay: str = "0 seconds",
    position: str | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The usable records, each when its window closes; on a stream the late ones are dropped.

    `keep` names the columns of `raw` that go along with a record (None: all). A stream holds them in its state until
    the window closes, and records that differ in one of them are rows of their own there: name those that are read.

    A table has no arrival order, so all its records are kept, unless `position` names the column
    that numbers the arrivals: then the late ones are dropped as a per-record watermark would.
    """
    records = good_records(normalise(raw, spec))
    if keep is not None:
        records = records.select(*dict.fromkeys([*keep, *([position] if position else []), *spec.fields, EVENT_TIME]))
    if position:
        return on_time_records(records, position, size)
    return window_release(records.withWatermark(EVENT_TIME, delay), size)


def released_state_events(raw: DataFrame, size: str = c.STATE_EVENT_WINDOW, **more) -> DataFrame:
    return released_records(raw, STATE_EVENTS, size, **more)


def released_passing_records(raw: DataFrame, size: str = c.PASSING_RECORD_WINDOW, **more) -> DataFrame:
    return released_records(raw, PASSING_RECORDS, size, **more)


def _bucketed(records: DataFrame, spec: RecordSpec, pattern: str, zone: str, clock: str | None) -> DataFrame:
    return with_bucket(records, time=clock, pattern=pattern, zone=zone).select(*spec.fields, "bucket")


def store_records(
    raw: DataFrame,
    spec: RecordSpec,
    path: str,
    fmt: str = "parquet",
    *,
    size: str,
    pattern: str,
    zone: str = c.BUCKET_ZONE,
    clock: str | None = EVENT_TIME,
    position: str | None = None,
    mode: str = "append",
    gather: bool = True,
) -> None:
    """Bounded input: normalise and write, record fields only, one folder per bucket."""
    released = released_records(raw, spec, size, position=position, keep=())
    write_bucketed(_bucketed(released, spec, pattern, zone, clock), path, fmt, mode=mode, gather=gather)


def start_records(
    raw: DataFrame,
    spec: RecordSpec,
    path: str,
    fmt: str = "parquet",
    *,
    checkpoint: str,
    size: str,
    pattern: str,
    every: str | None = None,
    delay: str = "0 seconds",
    zone: str = c.BUCKET_ZONE,
    clock: str | None = EVENT_TIME,
    max_records_per_file: int = 0,
) -> StreamingQuery:
    """Stream: the same, as windows close."""
    released = released_records(raw, spec, size, delay=delay, keep=())
    bucketed = _bucketed(released, spec, pattern, zone, clock)
    return start_bucketed(
        bucketed, path, fmt, checkpoint=checkpoint, every=every, max_records_per_file=max_records_per_file
    )


def start_state_events_to_parquet(
    raw: DataFrame, path: str, *, checkpoint: str, every: str | None = c.STATE_EVENT_CHECKPOINT_INTERVAL, **more
) -> StreamingQuery:
    """Equipment-state records in Parquet, a folder per minute."""
    settings = {"size": c.STATE_EVENT_WINDOW, "pattern": c.MINUTE_BUCKET, **more}
    return start_records(raw, STATE_EVENTS, path, "parquet", checkpoint=checkpoint, every=every, **settings)


def start_state_events_to_text(
    raw: DataFrame, path: str, *, checkpoint: str, every: str | None = c.STATE_TEXT_ROLL_INTERVAL, **more
) -> StreamingQuery:
    """Equipment-state records as JSON lines, a folder per minute, a new file each roll interval."""
    settings = {"size": c.STATE_EVENT_WINDOW, "pattern": c.MINUTE_BUCKET, **more}
    return start_records(raw, STATE_EVENTS, path, "text", checkpoint=checkpoint, every=every, **settings)


def start_passing_records_to_parquet(
    raw: DataFrame, path: str, *, checkpoint: str, every: str | None = c.PASSING_RECORD_CHECKPOINT_INTERVAL, **more
) -> StreamingQuery:
    """Passing records in Parquet, a folder per day."""
    settings = {"size": c.PASSING_RECORD_WINDOW, "pattern": c.DAY_BUCKET, **more}
    return start_records(raw, PASSING_RECORDS, path, "parquet", checkpoint=checkpoint, every=every, **settings)


def start_rejects(
    raw: DataFrame, spec: RecordSpec, path: str, *, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Keep the messages that no record could be made of, with the reason, in a folder per day of arrival."""
    refused = rejects(normalise(raw, spec), spec)
    bucketed = with_bucket(refused, time=None, pattern=c.DAY_BUCKET)
    return start_bucketed(bucketed, path, "json", checkpoint=checkpoint, every=every)


def record_sinks(spec: RecordSpec, path: str, fmt: str = "parquet", *, pattern: str, zone: str = c.BUCKET_ZONE, show: bool = False) -> list[BatchSink]:
    """Sinks for a micro-batch of normalised messages: records below `path/records` by bucket, what makes no record below
    `path/rejects`, and with `show` the records on the screen as well."""
    records, refused, shown = batch_folder_sink(f"{path}/records", fmt), batch_folder_sink(f"{path}/rejects"), print_sink()

    def store(batch: DataFrame, batch_id: int) -> None:
        records(_bucketed(good_records(batch), spec, pattern, zone, EVENT_TIME), batch_id)

    def refuse(batch: DataFrame, batch_id: int) -> None:
        refused(rejects(batch, spec), batch_id)

    def display(batch: DataFrame, batch_id: int) -> None:
        shown(good_records(batch).select(*spec.fields), batch_id)

    return [store, refuse, *([display] if show else [])]


def start_records_and_rejects(
    raw: DataFrame,
    spec: RecordSpec,
    path: str,
    fmt: str = "parquet",
    *,
    checkpoint: str,
    pattern: str,
    zone: str = c.BUCKET_ZONE,
    every: str | None = None,
    show: bool = False,
    more: Sequence[BatchSink] = (),
) -> StreamingQuery:
    """One query that parses every message once and sends it to records, rejects and the screen.

    Records come out as they arrive, without waiting for a window. A micro-batch is visible in `read_records` and
    `read_rejects` when all sinks have it (`path/commits`).
    """
    sinks = [*record_sinks(spec, path, fmt, pattern=pattern, zone=zone, show=show), *more]
    return fan_out(normalise(raw, spec), sinks, checkpoint=checkpoint, every=every, commits=f"{path}/commits")


def read_records(spark: SparkSession, spec: RecordSpec, path: str, fmt: str = "parquet") -> DataFrame:
    """The visible records: the fields, `batch_id` and `bucket`."""
    schema = ", ".join([*(f"`{name}` string" for name in spec.fields), "batch_id bigint", "bucket string"])
    return read_committed(spark, f"{path}/records", f"{path}/commits", schema, "json" if fmt == "text" else fmt)


def read_rejects(spark: SparkSession, path: str, schema: str = "value string") -> DataFrame:
    """The visible rejects: the columns of the raw messages (`schema`), `reject_reason` and `batch_id`."""
    return read_committed(spark, f"{path}/rejects", f"{path}/commits", f"{schema}, reject_reason string, batch_id bigint")
