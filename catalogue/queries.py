"""One query per operator (or group of operators), each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from catalogue import inputs
from windrow import constants as c
from windrow.functions.clock import zoned_text
from windrow.operators.counts import running_count, tumbling_count
from windrow.operators.event_time import only, with_event_time
from windrow.operators.lateness import late_audit, on_time_records, punctuated_watermark
from windrow.operators.normalise import (
    PASSING_RECORDS,
    STATE_EVENTS,
    good_records,
    normalise_passing_records,
    normalise_state_events,
    rejects,
)
from windrow.operators.tokens import whitespace_words
from windrow.plans import hot_items as hot
from windrow.plans import message_log, topic_records, word_counts
from windrow.schemas import MESSAGE, PASSING_RECORD, STATE_EVENT
from windrow.session import scratch_path
from windrow.sinks.buckets import read_bucketed, with_bucket, write_bucketed
from windrow.sinks.compaction import compact_buckets
from windrow.sinks.totals import fold_totals, read_totals, remove_folded
from windrow.sources.behavior import read_behavior_csv
from windrow.streaming.queries import (
    batch_folder_sink,
    fan_out,
    latest_totals,
    start_bucketed,
)
from windrow.streaming.stages import run_in_stages

Query = Callable[[SparkSession, str], DataFrame]

AUDIT_WINDOW = "60 minutes"
STAGES = 4


def plain(name: str) -> Column:
    """A timestamp without zone, as the tables have it."""
    return F.col(name).cast("timestamp_ntz").alias(name)


def _events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    return inputs.table(spark, sf_dir, "events", streaming=streaming)


def _messages(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    return inputs.messages(_events(spark, sf_dir, streaming))


# --- behaviour log ---------------------------------------------------------------------------------


def pv_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = with_event_time(inputs.behavior(_events(spark, sf_dir)), "timestamp", "s")
    return only(log, F.col("behavior") == c.PAGE_VIEW).select(
        "userId", "itemId", "categoryId", "behavior", "timestamp", plain("event_time")
    )


def behavior_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "behavior-csv")
    inputs.behavior(_events(spark, sf_dir)).select(*c.BEHAVIOR_FIELDS).write.csv(path, header=False)
    return read_behavior_csv(spark, path)


def behavior_csv_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = behavior_csv_roundtrip(spark, sf_dir)
    top = hot.hot_items(hot.page_views(log))
    return top.select(plain("window_end"), "itemId", "view_count", "rank")


def item_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = hot.item_window_counts(inputs.views(_events(spark, sf_dir)))
    return counts.select("itemId", plain("window_end"), "view_count")


def hot_items_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = hot.hot_items(inputs.views(_events(spark, sf_dir)))
    return top.select(plain("window_end"), "itemId", "view_count", "rank")


def hot_items_top5000(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More ranks than Spark's group limit cuts to."""
    top = hot.hot_items(inputs.views(_events(spark, sf_dir)), n=5000)
    return top.select(plain("window_end"), "itemId", "view_count", "rank")


def hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = hot.hot_items_report(inputs.views(_events(spark, sf_dir)), zone=c.BUCKET_ZONE)
    return reports.select(plain("window_end"), "report")


def tumbling_value_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = with_event_time(_events(spark, sf_dir), "ts", "ts")
    summed = tumbling_count(timed, ["event_type"], "60 minutes", value="user_id", name="user_sum")
    return summed.select("event_type", plain("window_start"), plain("window_end"), "user_sum")


# --- topic messages --------------------------------------------------------------------------------


def state_events_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = good_records(normalise_state_events(_messages(spark, sf_dir)))
    return records.select("event_id", *STATE_EVENTS.fields, plain("event_time"))


def state_events_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = rejects(normalise_state_events(_messages(spark, sf_dir)), STATE_EVENTS)
    return refused.select("event_id", "value", "reject_reason")


def state_events_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with a fraction or an exponent stay as they are written; a time with a fraction is none."""
    records = normalise_state_events(inputs.number_messages(_events(spark, sf_dir)))
    return records.select("event_id", *STATE_EVENTS.fields, "reject_reason")


def passing_records_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = good_records(normalise_passing_records(_messages(spark, sf_dir)))
    return records.select("event_id", *PASSING_RECORDS.fields, plain("event_time"))


def passing_records_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = rejects(normalise_passing_records(_messages(spark, sf_dir)), PASSING_RECORDS)
    return refused.select("event_id", "value", "reject_reason")


def state_events_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    released = topic_records.released_state_events(_messages(spark, sf_dir))
    return released.select("event_id", *STATE_EVENTS.fields, plain("window_start"), plain("window_end"))


def passing_records_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    released = topic_records.released_passing_records(_messages(spark, sf_dir))
    return released.select("event_id", *PASSING_RECORDS.fields, plain("window_start"), plain("window_end"))


def state_events_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    released = topic_records.released_state_events(_messages(spark, sf_dir), position="position")
    return released.select("event_id", *STATE_EVENTS.fields, plain("window_start"), plain("window_end"))


def passing_records_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    released = topic_records.released_passing_records(_messages(spark, sf_dir), position="position")
    return released.select("event_id", *PASSING_RECORDS.fields, plain("window_start"), plain("window_end"))


def state_events_key_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = good_records(normalise_state_events(_messages(spark, sf_dir)))
    counts = tumbling_count(records, "id", c.STATE_EVENT_WINDOW)
    return counts.select("id", plain("window_start"), plain("window_end"), "cnt")


# --- lateness --------------------------------------------------------------------------------------


def event_time_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    replayed = punctuated_watermark(inputs.arrivals(_events(spark, sf_dir)), "position")
    return replayed.select("event_id", "watermark_before", "watermark_after")


def late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = late_audit(inputs.arrivals(_events(spark, sf_dir)), "position", AUDIT_WINDOW)
    return audited.select("event_id", plain("window_end"), "is_late")


def late_records_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    audited = late_audit(
        inputs.arrivals(_events(spark, sf_dir)), "position", AUDIT_WINDOW, by=["source_partition"]
    )
    return audited.select("event_id", "source_partition", plain("window_end"), "is_late")


def on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = on_time_records(inputs.arrivals(_events(spark, sf_dir)), "position", AUDIT_WINDOW)
    return kept.select("event_id", plain("event_time"), plain("window_end"))


# --- words -----------------------------------------------------------------------------------------


def message_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts.message_counts(inputs.document_lines(inputs.table(spark, sf_dir, "documents")))


def message_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.document_lines(inputs.table(spark, sf_dir, "documents"))
    return word_counts.message_counts(lines, pattern=c.NON_WORD)


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.document_lines(inputs.table(spark, sf_dir, "documents"))
    return running_count(whitespace_words(lines.select("value")), "word")


def windowed_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.turn_lines(inputs.table(spark, sf_dir, "conversations"))
    counts = word_counts.windowed_word_counts(lines)
    return counts.select("word", plain("window_start"), plain("window_end"), "cnt")


def windowed_word_count_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.document_lines(inputs.table(spark, sf_dir, "documents"))
    counts = word_counts.windowed_word_counts(lines)
    return counts.select("word", plain("window_start"), plain("window_end"), "cnt")


# --- sinks -----------------------------------------------------------------------------------------
# Files go to a folder per day: the tables spread few rows over the minutes of 30 days.


def bucket_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    time = F.col("ts").cast("timestamp")
    return _events(spark, sf_dir).select(
        "event_id",
        zoned_text(time, c.MINUTE_BUCKET, c.BUCKET_ZONE).alias("minute_bucket"),
        zoned_text(time, c.DAY_BUCKET, c.BUCKET_ZONE).alias("day_bucket"),
    )


def bucketed_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "passing-parquet")
    topic_records.store_records(
        _messages(spark, sf_dir), PASSING_RECORDS, path, size=c.PASSING_RECORD_WINDOW, pattern=c.DAY_BUCKET
    )
    return read_bucketed(spark, path, PASSING_RECORD).select(*PASSING_RECORDS.fields, "bucket")


def bucketed_json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "state-text")
    topic_records.store_records(
        _messages(spark, sf_dir), STATE_EVENTS, path, "text", size=c.STATE_EVENT_WINDOW, pattern=c.DAY_BUCKET
    )
    return read_bucketed(spark, path, STATE_EVENT, "json").select(*STATE_EVENTS.fields, "bucket")


def bucketed_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "message-text")
    message_log.store_messages(_messages(spark, sf_dir), path, pattern=c.DAY_BUCKET)
    return read_bucketed(spark, path, MESSAGE, "text").select("value", "bucket")


def compacted_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_path(spark, "scattered"), scratch_path(spark, "compacted")
    events = with_bucket(
        _events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("event_time"), "value"),
        pattern=c.DAY_BUCKET,
    )
    write_bucketed(events, source)
    compact_buckets(spark, source, target, events.schema)
    return read_bucketed(spark, target, events.schema).select("event_id", plain("event_time"), "value", "bucket")


# --- streams: the tables read as streams, up to the last closed window -------------------------------


def hot_items_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "hot-items")
    views = inputs.views(_events(spark, sf_dir, streaming=True))
    hot.start_hot_items(
        views, [batch_folder_sink(f"{path}/out")], checkpoint=f"{path}/state"
    ).awaitTermination()
    top = spark.read.parquet(f"{path}/out")
    return top.select(plain("window_end"), "itemId", "view_count", "rank")


def hot_items_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "hot-items-report")
    views = inputs.views(_events(spark, sf_dir, streaming=True))
    hot.start_hot_items(
        views, [hot.report_sink(f"{path}/out", zone=c.BUCKET_ZONE)], checkpoint=f"{path}/state"
    ).awaitTermination()
    return spark.read.parquet(f"{path}/out").select(plain("window_end"), "report")


def window_release_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "release")
    released = topic_records.released_state_events(_messages(spark, sf_dir, streaming=True))
    bucketed = with_bucket(released, pattern=c.DAY_BUCKET)
    start_bucketed(bucketed, f"{path}/out", checkpoint=f"{path}/state").awaitTermination()
    stored = read_bucketed(spark, f"{path}/out", bucketed.schema)
    return stored.select("event_id", *STATE_EVENTS.fields, plain("window_start"), plain("window_end"), "bucket")


def passing_records_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "passing")
    topic_records.start_passing_records_to_parquet(
        _messages(spark, sf_dir, streaming=True), f"{path}/out", checkpoint=f"{path}/state", every=None
    ).awaitTermination()
    return read_bucketed(spark, f"{path}/out", PASSING_RECORD).select(*PASSING_RECORDS.fields, "bucket")


def message_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "message-log")
    message_log.start_message_log(
        _messages(spark, sf_dir, streaming=True),
        f"{path}/out",
        checkpoint=f"{path}/state",
        every=None,
        pattern=c.DAY_BUCKET,
    ).awaitTermination()
    return read_bucketed(spark, f"{path}/out", MESSAGE, "text").select("value", "bucket")


def running_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "running-count")
    lines = inputs.document_lines(inputs.table(spark, sf_dir, "documents", streaming=True))
    word_counts.start_message_counts(
        lines, f"{path}/out", checkpoint=f"{path}/state", every=None
    ).awaitTermination()
    return latest_totals(spark, f"{path}/out", ["word"])


def windowed_word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "word-count")
    lines = inputs.turn_lines(inputs.table(spark, sf_dir, "conversations", streaming=True))
    counts = word_counts.windowed_word_counts(lines.withWatermark("timestamp", "0 seconds"))
    fan_out(counts, [batch_folder_sink(f"{path}/out")], checkpoint=f"{path}/state").awaitTermination()
    counts = spark.read.parquet(f"{path}/out")
    return counts.select("word", plain("window_start"), plain("window_end"), "cnt")


def fan_out_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream of messages to two sinks: how often does each message occur in either?"""
    path = scratch_path(spark, "fan-out")
    lines = message_log.bucketed_lines(_messages(spark, sf_dir, streaming=True), pattern=c.DAY_BUCKET)
    sinks = [batch_folder_sink(f"{path}/parquet"), batch_folder_sink(f"{path}/text", "text")]
    fan_out(lines, sinks, checkpoint=f"{path}/state").awaitTermination()
    schema = "value string, batch_id bigint, bucket string"
    both = (
        spark.read.schema(schema).parquet(f"{path}/parquet").withColumn("sink", F.lit("parquet"))
        .union(spark.read.schema(schema).format("text").load(f"{path}/text").withColumn("sink", F.lit("text")))
    )
    return both.groupBy("sink", "bucket", "value").agg(F.count(F.lit(1)).alias("cnt"))


# --- streams that stop and go on: stretches of a whole table, a run of the query for each, one checkpoint -------------


def window_release_late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals out of order: what a stage brings for windows that earlier stages have closed is lost."""
    path = scratch_path(spark, "release-late")

    def start(raw: DataFrame) -> StreamingQuery:
        released = topic_records.released_state_events(raw, AUDIT_WINDOW, keep=["event_id"])
        return start_bucketed(with_bucket(released, pattern=c.DAY_BUCKET), f"{path}/out", checkpoint=f"{path}/state")

    run_in_stages(_messages(spark, sf_dir), "position", STAGES, f"{path}/feed", start)
    fields = ", ".join(f"{name} string" for name in STATE_EVENTS.fields)
    schema = f"event_id bigint, {fields}, window_start timestamp, window_end timestamp"
    stored = read_bucketed(spark, f"{path}/out", StructType.fromDDL(schema))
    return stored.select("event_id", *STATE_EVENTS.fields, plain("window_start"), plain("window_end"), "bucket")


def running_count_restart_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "running-count-restart")

    def start(documents: DataFrame) -> StreamingQuery:
        lines = inputs.document_lines(documents)
        return word_counts.start_message_counts(lines, f"{path}/out", checkpoint=f"{path}/state", every=None)

    run_in_stages(inputs.table(spark, sf_dir, "documents"), "doc_id", STAGES, f"{path}/feed", start)
    return latest_totals(spark, f"{path}/out", ["word"])


def running_count_folded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals after all stages, of which the changes of the first stages are folded into a snapshot and removed."""
    path = scratch_path(spark, "running-count-folded")
    store = f"{path}/totals"
    runs = []

    def start(documents: DataFrame) -> StreamingQuery:
        if len(runs) == STAGES // 2:
            fold_totals(spark, store, ["word"])
            remove_folded(spark, store)
        runs.append(1)
        lines = inputs.document_lines(documents)
        return word_counts.start_message_totals(lines, store, checkpoint=f"{path}/state", every=None)

    run_in_stages(inputs.table(spark, sf_dir, "documents"), "doc_id", STAGES, f"{path}/feed", start)
    return read_totals(spark, store, ["word"])


def hot_items_timer_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "hot-items-timer")

    def start(events: DataFrame) -> StreamingQuery:
        return hot.start_hot_items_by_timer(inputs.views(events), f"{path}/out", checkpoint=f"{path}/state")

    run_in_stages(_events(spark, sf_dir), "event_id", 2, f"{path}/feed", start)
    top = spark.read.parquet(f"{path}/out")
    return top.select(plain("window_end"), "itemId", "view_count", "rank")


def hot_items_all_behavior_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log itself as a stream: every record moves the watermark, page views are counted."""
    path = scratch_path(spark, "hot-items-behavior")
    views = hot.page_views(inputs.behavior(_events(spark, sf_dir, streaming=True)))
    hot.start_hot_items(views, [batch_folder_sink(f"{path}/out")], checkpoint=f"{path}/state").awaitTermination()
    top = spark.read.parquet(f"{path}/out")
    return top.select(plain("window_end"), "itemId", "view_count", "rank")


def records_and_rejects_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query for records and rejects, restarted between stages: how often is each in what is visible?"""
    path = scratch_path(spark, "records-rejects")

    def start(raw: DataFrame) -> StreamingQuery:
        return topic_records.start_records_and_rejects(
            raw, STATE_EVENTS, f"{path}/out", checkpoint=f"{path}/state", pattern=c.DAY_BUCKET
        )

    run_in_stages(_messages(spark, sf_dir).select("value", "position"), "position", STAGES, f"{path}/feed", start)
    records = topic_records.read_records(spark, STATE_EVENTS, f"{path}/out")
    refused = topic_records.read_rejects(spark, f"{path}/out", "value string, position bigint")
    both = records.select("id", "time", "bucket", F.lit(None).cast("string").alias("reject_reason")).unionByName(
        refused.select("reject_reason"), allowMissingColumns=True
    )
    return both.groupBy("id", "time", "bucket", "reject_reason").agg(F.count(F.lit(1)).alias("cnt"))


QUERIES: dict[str, Query] = {
    "pv_filter": pv_filter,
    "behavior_csv_roundtrip": behavior_csv_roundtrip,
    "behavior_csv_hot_items": behavior_csv_hot_items,
    "item_window_counts": item_window_counts,
    "hot_items_topn": hot_items_topn,
    "hot_items_top5000": hot_items_top5000,
    "hot_items_report": hot_items_report,
    "tumbling_value_sum": tumbling_value_sum,
    "state_events_normalised": state_events_normalised,
    "state_events_rejects": state_events_rejects,
    "state_events_number_text": state_events_number_text,
    "passing_records_normalised": passing_records_normalised,
    "passing_records_rejects": passing_records_rejects,
    "state_events_windowed": state_events_windowed,
    "passing_records_windowed": passing_records_windowed,
    "state_events_on_time": state_events_on_time,
    "passing_records_on_time": passing_records_on_time,
    "state_events_key_window_counts": state_events_key_window_counts,
    "event_time_watermark": event_time_watermark,
    "late_audit": late_records,
    "late_audit_by_partition": late_records_by_partition,
    "on_time_records": on_time,
    "message_running_count": message_running_count,
    "message_word_count": message_word_count,
    "word_count": word_count,
    "windowed_word_count": windowed_word_count,
    "windowed_word_count_documents": windowed_word_count_documents,
    "bucket_names": bucket_names,
    "bucketed_parquet_roundtrip": bucketed_parquet_roundtrip,
    "bucketed_json_lines_roundtrip": bucketed_json_lines_roundtrip,
    "bucketed_text_roundtrip": bucketed_text_roundtrip,
    "compacted_buckets": compacted_buckets,
    "hot_items_stream": hot_items_stream,
    "hot_items_report_stream": hot_items_report_stream,
    "window_release_stream": window_release_stream,
    "passing_records_stream": passing_records_stream,
    "message_log_stream": message_log_stream,
    "running_count_stream": running_count_stream,
    "windowed_word_count_stream": windowed_word_count_stream,
    "fan_out_stream": fan_out_stream,
    "window_release_late_stream": window_release_late_stream,
    "running_count_restart_stream": running_count_restart_stream,
    "running_count_folded_stream": running_count_folded_stream,
    "hot_items_timer_stream": hot_items_timer_stream,
    "hot_items_all_behavior_stream": hot_items_all_behavior_stream,
    "records_and_rejects_stream": records_and_rejects_stream,
}
