"""Streams of several ordered files: closed windows, late records, restarts."""

import contextlib
import io
import os

import pytest
from catalogue import inputs
from pyspark.sql import functions as F

from windrow.operators.counts import sliding_count, tumbling_count
from windrow.operators.release import window_release
from windrow.plans import hot_items as hot
from windrow.plans import message_log, topic_records, word_counts
from windrow.operators.normalise import STATE_EVENTS
from windrow.schemas import MESSAGE, PASSING_RECORD, STATE_EVENT
from windrow.sinks.buckets import read_bucketed
from windrow.sinks.compaction import compact_buckets
from windrow.streaming import fan_out, latest_totals, start_bucketed, start_console, start_top_n
from windrow.streaming.queries import batch_folder_sink, print_sink


class Feed:
    """A folder of Parquet files with rising modification times; one file per micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.path, self.schema, self.files = spark, f"{folder}/feed", schema, 0
        os.makedirs(self.path)

    def add(self, df):
        df = df if not isinstance(df, list) else self.spark.createDataFrame(df, self.schema)
        pandas = df.toPandas()
        self.files += 1
        path = f"{self.path}/{self.files:04d}.parquet"
        staged = f"{os.path.dirname(self.path)}/{self.files:04d}"
        df.sparkSession.createDataFrame(pandas, df.schema).coalesce(1).write.parquet(staged)
        part = next(n for n in os.listdir(staged) if n.startswith("part-"))
        with open(f"{staged}/{part}", "rb") as src, open(path, "wb") as out:
            out.write(src.read())
        stamp = 1_700_000_000 + 10 * self.files
        os.utime(path, (stamp, stamp))

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def _timed(df):
    return df.withColumn("event_time", F.timestamp_millis("ms")).withWatermark("event_time", "0 seconds")


RECORDS = "k string, ms bigint"


def _released(spark, folder):
    return sorted(map(tuple, spark.read.parquet(f"{folder}/out").select("k", "ms").collect()))


def _run_release(feed, folder, delay="0 seconds"):
    timed = feed.stream().withColumn("event_time", F.timestamp_millis("ms")).withWatermark("event_time", delay)
    released = window_release(timed, "10 seconds").withColumn("bucket", F.lit("all"))
    query = start_bucketed(released, f"{folder}/out", checkpoint=f"{folder}/state")
    query.awaitTermination()
    return query


def test_release_holds_drops_and_goes_on_after_a_restart(spark, folder):
    feed = Feed(spark, folder, RECORDS)
    feed.add([("a", 1_000), ("a", 1_000), ("b", 9_999)])
    feed.add([("a", 12_000)])
    _run_release(feed, folder)
    assert _released(spark, folder) == [("a", 1_000), ("a", 1_000), ("b", 9_999)]

    feed.add([("late", 5_000), ("a", 13_000)])  # the window of the first record is closed
    feed.add([("a", 25_000)])
    query = _run_release(feed, folder)
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1
    assert _released(spark, folder) == [
        ("a", 1_000), ("a", 1_000), ("a", 12_000), ("a", 13_000), ("b", 9_999),
    ]
    _run_release(feed, folder)  # nothing new: nothing twice
    assert len(_released(spark, folder)) == 5


def test_release_boundary(spark, folder):
    feed = Feed(spark, folder, RECORDS)
    feed.add([("a", 9_999)])
    _run_release(feed, folder)
    assert not os.path.isdir(f"{folder}/out/bucket=all")  # the last millisecond does not close a window here
    feed.add([("b", 10_000)])
    _run_release(feed, folder)
    assert _released(spark, folder) == [("a", 9_999)]


def test_release_of_many_equal_copies(spark, folder):
    feed = Feed(spark, folder, RECORDS)
    feed.add(spark.range(5_000).select(F.lit("hot").alias("k"), F.lit(1_000).cast("bigint").alias("ms")))
    feed.add([("end", 10_000)])
    _run_release(feed, folder)
    assert _released(spark, folder) == [("hot", 1_000)] * 5_000


def test_a_late_view_still_counts_in_windows_that_are_open(spark, folder):
    feed = Feed(spark, folder, RECORDS)
    feed.add([("a", 20_000)])
    feed.add([("a", 21_000)])
    # lateness goes by the watermark the micro-batch before ended with, so from here on by 20 s:
    feed.add([("lost", 14_000), ("half", 18_000)])  # half: its window up to 20 is closed, up to 25 open
    feed.add([("end", 60_000)])
    counts = sliding_count(_timed(feed.stream()), "k", "10 seconds", "5 seconds")
    fan_out(counts, [batch_folder_sink(f"{folder}/out")], checkpoint=f"{folder}/state").awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").select("k", F.unix_seconds("window_end"), "cnt").collect()
    assert sorted(map(tuple, rows)) == [("a", 25, 2), ("a", 30, 2), ("half", 25, 1)]


def test_each_window_leaves_in_one_micro_batch(spark, folder, events_feed):
    _, feed = events_feed
    counts = hot.item_window_counts(inputs.views(feed.stream()))
    fan_out(counts, [batch_folder_sink(f"{folder}/out")], checkpoint=f"{folder}/state").awaitTermination()
    batches = spark.read.parquet(f"{folder}/out").groupBy("window_end").agg(F.count_distinct("batch_id").alias("n"))
    assert batches.filter("n > 1").count() == 0 and batches.count() > 0


def _ordered_parts(events, parts):
    bounds = events.stat.approxQuantile("event_id", [i / parts for i in range(1, parts)], 0)
    bounds = [-1, *bounds, float("inf")]
    for low, high in zip(bounds, bounds[1:]):
        yield events.filter((F.col("event_id") > low) & (F.col("event_id") <= high))


@pytest.fixture()
def events_feed(spark, folder, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    feed = Feed(spark, folder, inputs.EVENTS)
    for part in _ordered_parts(events, 5):
        feed.add(part)
    return events, feed


def test_hot_items_stream_equals_batch_on_closed_windows(spark, folder, events_feed):
    events, feed = events_feed
    sinks = [batch_folder_sink(f"{folder}/top"), hot.report_sink(f"{folder}/reports")]
    hot.start_hot_items(inputs.views(feed.stream()), sinks, checkpoint=f"{folder}/state").awaitTermination()

    last = inputs.views(events).agg(F.max("event_time")).first()[0]
    columns = ["window_end", "itemId", "view_count", "rank"]
    batch = hot.hot_items(inputs.views(events)).filter(F.col("window_end") <= last).select(*columns)
    streamed = spark.read.parquet(f"{folder}/top").select(*columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert streamed.select("window_end").distinct().count() == spark.read.parquet(f"{folder}/reports").count()


def test_state_events_stream_in_each_format(spark, folder, events_feed):
    events, feed = events_feed
    plain = inputs.messages(feed.stream()).select("value", "timestamp")
    topic_records.start_state_events_to_parquet(
        plain, f"{folder}/parquet", checkpoint=f"{folder}/s1", every=None, pattern="yyyy-MM-dd"
    ).awaitTermination()
    topic_records.start_state_events_to_text(
        plain, f"{folder}/text", checkpoint=f"{folder}/s2", every=None, pattern="yyyy-MM-dd"
    ).awaitTermination()
    parquet = read_bucketed(spark, f"{folder}/parquet", STATE_EVENT)
    text = read_bucketed(spark, f"{folder}/text", STATE_EVENT, "json").select(*parquet.columns)
    assert parquet.columns == [*STATE_EVENTS.fields, "bucket"]
    assert parquet.count() > 0
    assert parquet.exceptAll(text).count() == 0 and text.exceptAll(parquet).count() == 0
    stored = topic_records.released_state_events(inputs.messages(events)).select(*STATE_EVENTS.fields)
    assert parquet.drop("bucket").exceptAll(stored).count() == 0


def test_rejects_stream(spark, folder, events_feed):
    events, feed = events_feed
    topic_records.start_rejects(
        inputs.messages(feed.stream()), STATE_EVENTS, f"{folder}/rejects", checkpoint=f"{folder}/state"
    ).awaitTermination()
    reasons = spark.read.json(f"{folder}/rejects").groupBy("reject_reason").count().collect()
    expected = events.count() // 50
    assert {r.reject_reason: r["count"] for r in reasons} == {
        "empty_message": expected, "malformed_json": expected, "bad_event_time": expected,
    }


def test_message_log_restart(spark, folder):
    schema = "value string, timestamp timestamp"
    feed = Feed(spark, folder, schema)

    def run():
        message_log.start_message_log(
            feed.stream(), f"{folder}/out", checkpoint=f"{folder}/state", every=None
        ).awaitTermination()
        return sorted(r.value for r in read_bucketed(spark, f"{folder}/out", MESSAGE, "text").collect())

    day = spark.sql("select timestamp'2024-01-01 00:00:30' t").first().t
    feed.add([("a", day), ("b", day)])
    assert run() == ["a", "b"]
    feed.add([("c", day)])
    feed.add([("a", day)])
    assert run() == ["a", "a", "b", "c"]
    assert run() == ["a", "a", "b", "c"]
    assert os.path.isdir(f"{folder}/out/bucket=2024-01-01--0800")


def test_running_totals_restart(spark, folder):
    feed = Feed(spark, folder, "value string")

    def run():
        word_counts.start_message_counts(
            feed.stream(), f"{folder}/out", checkpoint=f"{folder}/state", every=None
        ).awaitTermination()
        return {r.word: r.cnt for r in latest_totals(spark, f"{folder}/out", ["word"]).collect()}

    feed.add([("A",), ("a",), ("b",)])
    assert run() == {"a": 2, "b": 1}
    feed.add([("a",)])
    feed.add([("",), ("C",)])
    assert run() == {"a": 3, "b": 1, "c": 1}
    assert run() == {"a": 3, "b": 1, "c": 1}


def test_windowed_words_stream(spark, folder):
    feed = Feed(spark, folder, "value string, ms bigint")
    feed.add([("a b a", 1_000), ("a", 4_999)])
    feed.add([("b", 5_000)])
    feed.add([("c", 11_000)])
    lines = _timed(feed.stream()).withColumnRenamed("event_time", "timestamp")
    counts = word_counts.windowed_word_counts(lines)
    fan_out(counts, [batch_folder_sink(f"{folder}/out")], checkpoint=f"{folder}/state").awaitTermination()
    rows = spark.read.parquet(f"{folder}/out").select("word", F.unix_seconds("window_end"), "cnt").collect()
    assert sorted(map(tuple, rows)) == [("a", 5, 3), ("b", 5, 1), ("b", 10, 1)]


def test_a_repeated_batch_replaces_its_first_attempt(spark, folder):
    sink = batch_folder_sink(f"{folder}/out")
    df = spark.range(3).withColumn("bucket", F.lit("x"))
    sink(df, 7)
    sink(df, 7)
    sink(df, 8)
    assert spark.read.parquet(f"{folder}/out").groupBy("batch_id").count().count() == 2
    assert spark.read.parquet(f"{folder}/out").count() == 6


def test_printing(spark, folder, events_feed):
    _, feed = events_feed
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        counts = tumbling_count(inputs.views(feed.stream()), "itemId", "1 day", name="view_count")
        start_top_n(
            counts, 2, [hot.report_sink(), print_sink()], checkpoint=f"{folder}/s1"
        ).awaitTermination()
    assert "No0:  商品ID=" in out.getvalue() and "view_count" in out.getvalue()
    start_console(feed.stream(), checkpoint=f"{folder}/s2").awaitTermination()


def test_printing_is_complete(spark, capsys):
    print_sink()(spark.range(50).selectExpr("concat('row-', id) AS name"), 0)
    assert capsys.readouterr().out.count("row-") == 50


def test_failures_surface(spark, folder):
    feed = Feed(spark, folder, RECORDS)
    feed.add([("a", 1)])

    def broken(batch, batch_id):
        raise RuntimeError("sink failed")

    query = fan_out(feed.stream(), [broken], checkpoint=f"{folder}/state")
    with pytest.raises(Exception, match="sink failed"):
        query.awaitTermination()


def test_passing_records_stream_keeps_fields_only(spark, folder):
    feed = Feed(spark, folder, "value string")
    feed.add([('{"RAWID":"p","pos":1000}',), ('{"RAWID":"p"}',)])
    feed.add([('{"RAWID":"q","pos":61000}',)])
    topic_records.start_passing_records_to_parquet(
        feed.stream(), f"{folder}/out", checkpoint=f"{folder}/state", every=None
    ).awaitTermination()
    rows = read_bucketed(spark, f"{folder}/out", PASSING_RECORD).collect()
    assert [tuple(r) for r in rows] == [("1000", "p", "1970-01-01")]


def test_a_busy_key_is_spread(spark, folder):
    feed = Feed(spark, folder, RECORDS)
    feed.add(spark.range(2_000).select(F.lit("busy").alias("k"), F.col("id").alias("ms")))
    feed.add([("end", 10_000)])
    _run_release(feed, folder)
    files = [n for n in os.listdir(f"{folder}/out/bucket=all") if n.startswith("part-")]
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(_released(spark, folder)) == 2_000


def test_a_sink_that_fails_once_leaves_nothing_twice(spark, folder):
    feed = Feed(spark, folder, RECORDS)
    feed.add([("a", 1), ("b", 2)])
    attempts = []

    def fails_at_first(batch, batch_id):
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise RuntimeError("lost")
        batch_folder_sink(f"{folder}/second")(batch, batch_id)

    def run():
        sinks = [batch_folder_sink(f"{folder}/first"), fails_at_first]
        fan_out(feed.stream(), sinks, checkpoint=f"{folder}/state").awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert attempts == [0, 0]
    for name in ("first", "second"):
        assert sorted(r.k for r in spark.read.parquet(f"{folder}/{name}").collect()) == ["a", "b"]


def test_files_roll_by_batch_and_rows_and_are_compacted(spark, folder):
    feed = Feed(spark, folder, "value string, bucket string")
    for n in range(3):
        feed.add([(f"{n}-{i}", "b") for i in range(10)])
    start_bucketed(
        feed.stream(), f"{folder}/out", "text", checkpoint=f"{folder}/state", max_records_per_file=4
    ).awaitTermination()

    def files(path):
        return [n for n in os.listdir(f"{path}/bucket=b") if n.startswith("part-")]

    assert len(files(f"{folder}/out")) == 9
    compact_buckets(spark, f"{folder}/out", f"{folder}/compact", MESSAGE, "text")
    assert len(files(f"{folder}/compact")) == 1
    rows = [r.value for r in read_bucketed(spark, f"{folder}/compact", MESSAGE, "text").collect()]
    assert sorted(rows) == sorted(f"{n}-{i}" for n in range(3) for i in range(10))


@pytest.mark.parametrize("delay, kept", [("0 seconds", False), ("10 seconds", True)])
def test_a_delay_waits_for_late_records(spark, folder, delay, kept):
    feed = Feed(spark, folder, RECORDS)
    feed.add([("a", 12_000)])
    feed.add([("a", 13_000)])
    feed.add([("late", 5_000)])
    feed.add([("end", 60_000)])
    _run_release(feed, folder, delay)
    expected = [("a", 12_000), ("a", 13_000)] + ([("late", 5_000)] if kept else [])
    assert _released(spark, folder) == expected
