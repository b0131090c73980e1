"""Run a job: `python -m windrow <job>`, or `spark-submit --py-files windrow.zip windrow/__main__.py <job>`.

Jobs: hot-items, state-events, passing-records, message-log, message-counts, word-counts. Their
settings default to the values in `windrow.constants`. `--once` processes what is there and stops.
`hot-items --table` takes the files as the whole log, so that the last windows come out as well.

Upkeep: `compact` rewrites the buckets of a job in files of about a roll size; `fold-counts` folds the
changes that message-counts has logged into a snapshot.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windrow import constants as c
from windrow.plans import hot_items, message_log, topic_records, word_counts
from windrow.session import build_session
from windrow.sources.behavior import read_behavior_csv
from windrow.sources.lines import socket_lines, text_lines
from windrow.sources.topics import TopicSpec, raw_messages
from windrow.sinks.compaction import compact_buckets
from windrow.sinks.totals import fold_totals, remove_folded
from windrow.streaming.queries import start_console, start_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="windrow", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, every: str, output: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("--checkpoint", required=name != "hot-items", help="folder the job recovers from")
        sub.add_argument("--every", default=every, help="pause between micro-batches")
        sub.add_argument("--once", action="store_true", help="process what is there and stop")
        if output:
            sub.add_argument("--output", required=True)
        return sub

    def messages(sub: argparse.ArgumentParser) -> None:
        source = sub.add_mutually_exclusive_group(required=True)
        source.add_argument("--topic")
        source.add_argument("--files", help="folder of text files, a message per line")
        sub.add_argument("--servers", help="brokers of the topic")
        sub.add_argument("--group")
        sub.add_argument("--from", dest="start", default="latest", help="where a new job begins")

    def buckets(sub: argparse.ArgumentParser, pattern: str) -> None:
        sub.add_argument("--bucket", default=pattern, help="date pattern of the folders")
        sub.add_argument("--zone", default=c.BUCKET_ZONE)

    hot = job("hot-items", c.STATE_EVENT_CHECKPOINT_INTERVAL, output=False)
    hot.add_argument("--input", required=True, help="folder of behaviour CSV files")
    hot.add_argument("--output", help="folder for the reports; printed when missing")
    hot.add_argument("--table", action="store_true", help="the files are the whole log: no stream, no checkpoint")
    hot.add_argument("--top", type=int, default=c.HOT_ITEMS_TOP)
    hot.add_argument("--window", default=c.HOT_ITEMS_WINDOW)
    hot.add_argument("--slide", default=c.HOT_ITEMS_SLIDE)
    hot.add_argument("--zone", default="UTC", help="zone of the times in the report")

    state = job("state-events", c.STATE_EVENT_CHECKPOINT_INTERVAL)
    state.add_argument("--format", choices=("parquet", "text"), default="parquet")
    state.set_defaults(spec=topic_records.STATE_EVENTS)
    passing = job("passing-records", c.PASSING_RECORD_CHECKPOINT_INTERVAL)
    passing.add_argument("--format", choices=("parquet", "text"), default="parquet")
    passing.set_defaults(spec=topic_records.PASSING_RECORDS)
    for sub, window, pattern in (
        (state, c.STATE_EVENT_WINDOW, c.MINUTE_BUCKET), (passing, c.PASSING_RECORD_WINDOW, c.DAY_BUCKET),
    ):
        messages(sub)
        buckets(sub, pattern)
        sub.add_argument("--window", default=window)
        sub.add_argument("--delay", default="0 seconds", help="how long to wait for late records")
        sub.add_argument("--rejects", help="folder for the messages that make no record")
        sub.add_argument("--max-records-per-file", type=int, default=0, help="a new file after so many rows; 0: no bound")
        sub.add_argument(
            "--at-once", action="store_true",
            help="one query for records, rejects and the screen; records do not wait for their window",
        )

    log = job("message-log", c.MESSAGE_LOG_ROLL_INTERVAL)
    messages(log)
    buckets(log, c.MINUTE_BUCKET)
    log.add_argument("--max-records-per-file", type=int, default=0, help="a new file after so many rows; 0: no bound")

    counts = job("message-counts", c.MESSAGE_CHECKPOINT_INTERVAL)
    messages(counts)
    counts.add_argument("--pattern", default=c.LINE_SEPARATOR, help="what parts words")
    counts.add_argument("--totals", action="store_true", help="keep a snapshot and changes, for fold-counts, instead of a log")

    words = job("word-counts", c.WORD_COUNT_WINDOW, output=False)
    words.add_argument("--host")
    words.add_argument("--port", type=int)
    words.add_argument("--files", help="folder of text files instead of a socket")
    words.add_argument("--window", default=c.WORD_COUNT_WINDOW)
    words.add_argument("--output", help="folder for a row per word and window, stored once when the window closes")
    words.add_argument("--closed", action="store_true", help="print a window once, when it closes, not with every change")

    compact = jobs.add_parser("compact")
    compact.add_argument("--input", required=True, help="folder of buckets")
    compact.add_argument("--output", required=True)
    compact.add_argument("--format", choices=("parquet", "text"), default="parquet")
    compact.add_argument("--roll-bytes", type=int, default=c.ROLL_BYTES)
    compact.add_argument("--buckets", nargs="*", help="buckets that no longer grow; all when missing")
    compact.add_argument("--manifests", help="folder that remembers what was folded")

    fold = jobs.add_parser("fold-counts")
    fold.add_argument("--store", required=True, help="the --output of message-counts --totals")
    fold.add_argument("--remove", action="store_true", help="remove what is folded")
    return parser


def _raw(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.files:
        return text_lines(spark, args.files, streaming=True)
    spec = TopicSpec(args.servers, args.topic, group_id=args.group, starting_offsets=args.start)
    return raw_messages(spark, spec)


def _start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    every = None if args.once else args.every
    if args.job == "hot-items":
        views = hot_items.page_views(read_behavior_csv(spark, args.input, streaming=True))
        sinks = [hot_items.report_sink(args.output, zone=args.zone)]
        return [
            hot_items.start_hot_items(
                views, sinks, checkpoint=args.checkpoint, n=args.top, every=every, size=args.window, slide=args.slide
            )
        ]
    if args.job in ("state-events", "passing-records"):
        raw = _raw(spark, args)
        if args.at_once:
            return [
                topic_records.start_records_and_rejects(
                    raw, args.spec, args.output, args.format, checkpoint=args.checkpoint,
                    pattern=args.bucket, zone=args.zone, every=every, show=True,
                )
            ]
        queries = [
            topic_records.start_records(
                raw, args.spec, args.output, args.format, checkpoint=f"{args.checkpoint}/records",
                size=args.window, pattern=args.bucket, zone=args.zone, every=every, delay=args.delay,
                max_records_per_file=args.max_records_per_file,
            )
        ]
        if args.rejects:
            queries.append(
                topic_records.start_rejects(
                    raw, args.spec, args.rejects, checkpoint=f"{args.checkpoint}/rejects", every=every
                )
            )
        return queries
    if args.job == "message-log":
        clock = None if args.files else "timestamp"
        return [
            message_log.start_message_log(
                _raw(spark, args), args.output, checkpoint=args.checkpoint, every=every,
                clock=clock, pattern=args.bucket, zone=args.zone, max_records_per_file=args.max_records_per_file,
            )
        ]
    if args.job == "message-counts":
        return [
            (word_counts.start_message_totals if args.totals else word_counts.start_message_counts)(
                _raw(spark, args), args.output, checkpoint=args.checkpoint, every=every, pattern=args.pattern
            )
        ]
    if args.files:
        lines = text_lines(spark, args.files, streaming=True).withColumn("timestamp", F.current_timestamp())
    else:
        lines = socket_lines(spark, args.host, args.port)
    counts = word_counts.windowed_word_counts(lines.withWatermark("timestamp", "0 seconds"), size=args.window)
    if args.output:
        return [start_files(counts, args.output, checkpoint=args.checkpoint, every=every)]
    mode = "append" if args.closed else "update"
    return [start_console(counts, checkpoint=args.checkpoint, mode=mode, every=every)]


def _run(spark: SparkSession, args: argparse.Namespace) -> bool:
    """Jobs without a stream; False for others."""
    if args.job == "hot-items" and args.table:
        views = hot_items.page_views(read_behavior_csv(spark, args.input))
        top = hot_items.hot_items(views, args.top, size=args.window, slide=args.slide)
        hot_items.report_sink(args.output, zone=args.zone)(top, 0)
    elif args.job == "compact":
        files = spark.read.format("parquet" if args.format == "parquet" else "text").load(args.input)
        done = compact_buckets(
            spark, args.input, args.output, files.schema, args.format, roll_bytes=args.roll_bytes,
            buckets=args.buckets, manifests=args.manifests,
        )
        print(f"{len(done)} buckets written")
    elif args.job == "fold-counts":
        folded = fold_totals(spark, args.store, ["word"])
        if args.remove:
            remove_folded(spark, args.store)
        print("folded" if folded else "nothing to fold")
    else:
        return False
    return True


def main(argv: Sequence[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "hot-items" and not (args.table or args.checkpoint):
        parser.error("hot-items needs --checkpoint or --table")
    spark = build_session(f"windrow {args.job}")
    if _run(spark, args):
        return
    queries = _start(spark, args)
    if args.once:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
