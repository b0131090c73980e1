"""Streams that stop and go on: stages, timers, totals in a snapshot and changes, several sinks at once."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from catalogue import inputs
from windrow.__main__ import main
from windrow.operators.normalise import STATE_EVENTS
from windrow.plans import hot_items as hot
from windrow.plans import topic_records, word_counts
from windrow.session import state_in_rocksdb
from windrow.sinks.buckets import read_bucketed, write_bucketed
from windrow.sinks.commits import commit_batch, last_commit, publish, published, read_published
from windrow.sinks.compaction import bucket_files, compact_buckets
from windrow.sinks.totals import fold_totals, manifest, read_totals, remove_folded
from windrow.streaming import fan_out, start_files, top_n_by_timer
from windrow.streaming.queries import batch_folder_sink
from windrow.streaming.stages import run_in_stages, stage_bounds

BEHAVIOR = "userId long, itemId long, categoryId int, behavior string, timestamp long"
HOUR = 1_704_067_200


def _dropped(queries):
    return [sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators) for q in queries]


def test_stage_bounds(spark):
    df = spark.createDataFrame([(5,), (14,), (None,), (6,)], "p long")
    assert stage_bounds(df, "p", 3) == [(5, 9), (9, 13), (13, 17)]
    assert stage_bounds(df, "p", 1) == [(5, 15)]
    assert stage_bounds(df.limit(0), "p", 3) == []


def test_stages_carry_watermark_and_state_over(spark, folder):
    # position, ms: the second stage comes too late for the window of the first, unless that is still open
    rows = [(0, 1_000), (1, 25_000), (10, 2_000), (11, 21_000), (20, 3_000), (21, 60_000)]
    df = spark.createDataFrame(rows, "position long, ms long")

    def start(raw):
        records = raw.withColumn("event_time", F.timestamp_millis("ms")).withWatermark("event_time", "0 seconds")
        from windrow.operators.release import window_release

        return start_files(window_release(records, "10 seconds"), f"{folder}/out", checkpoint=f"{folder}/state")

    queries = run_in_stages(df, "position", 3, f"{folder}/feed", start)
    assert _dropped(queries) == [0, 1, 1]
    assert sorted(r.ms for r in spark.read.parquet(f"{folder}/out").collect()) == [1_000, 21_000, 25_000]


def test_the_registered_stages_drop_rows(spark, folder, sf_dir):
    messages = inputs.messages(inputs.table(spark, sf_dir, "events"))

    def start(raw):
        released = topic_records.released_state_events(raw, "60 minutes", keep=["event_id"])
        return start_files(released, f"{folder}/out", checkpoint=f"{folder}/state")

    dropped = _dropped(run_in_stages(messages, "position", 4, f"{folder}/feed", start))
    assert dropped[0] == 0 and min(dropped[1:]) > 0


def test_every_record_moves_the_watermark(spark, folder):
    log = spark.createDataFrame([(1, 7, 1, "pv", HOUR), (1, 7, 1, "buy", HOUR + 7_200)], BEHAVIOR)
    log.coalesce(1).write.parquet(f"{folder}/in")
    views = hot.page_views(spark.readStream.schema(log.schema).parquet(f"{folder}/in"))
    hot.start_hot_items(views, [batch_folder_sink(f"{folder}/out")], checkpoint=f"{folder}/state").awaitTermination()
    top = spark.read.parquet(f"{folder}/out")
    assert top.count() == 12 and {r.itemId for r in top.collect()} == {7}
    stored = hot.page_views(spark.read.parquet(f"{folder}/in"))
    assert "PushedFilters: [IsNotNull(behavior), EqualTo(behavior,pv)]" in stored._jdf.queryExecution().executedPlan().toString()


def test_a_finite_log_as_a_table(spark, folder, capsys):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.csv", "w", encoding="utf-8") as out:
        out.write(f"1,7,1,pv,{HOUR}\n2,8,1,buy,{HOUR}\n")
    main(["hot-items", "--table", "--input", f"{folder}/in"])
    assert capsys.readouterr().out.count("No0:  商品ID=7  浏览量=1") == 12  # the last windows too
    with pytest.raises(SystemExit):
        main(["hot-items", "--input", f"{folder}/in"])


# --- list state and timer ----------------------------------------------------------------------------


def test_a_restart_between_state_and_timer(spark, folder):
    rows = [(0, "a", 1_000), (1, "a", 2_000), (2, "b", 3_000), (3, "c", 4_000), (4, "x", 10_000), (20, "x", 10_001), (40, "y", 30_000)]
    df = spark.createDataFrame(rows, "position long, itemId string, ms long")

    def start(raw):
        views = raw.withColumn("event_time", F.timestamp_millis("ms")).withWatermark("event_time", "0 seconds")
        counts = hot.item_window_counts(views, size="10 seconds", slide="10 seconds")
        with state_in_rocksdb(spark):
            return start_files(top_n_by_timer(counts, 2), f"{folder}/out", checkpoint=f"{folder}/state")

    def seen():
        return sorted((r.rank, r.itemId, r.view_count) for r in spark.read.schema("window_end timestamp, itemId string, view_count long, rank long").parquet(f"{folder}/out").collect())

    def held():
        reader = spark.read.format("statestore").option("path", f"{folder}/state").option("operatorId", 0)
        return reader.option("stateVarName", "counts").load().count()

    results = []

    def noted(raw):
        if raw is not None and results is not None and os.path.isdir(f"{folder}/out"):
            results.append((seen(), held()))
        return start(raw)

    run_in_stages(df, "position", 3, f"{folder}/feed", noted)
    # the watermark at the window's end: counted and held, the timer waits for a millisecond more
    assert results[0] == ([], 3)
    assert results[1][0] == [(1, "a", 2), (2, "b", 1)]
    assert seen() == [(1, "a", 2), (1, "x", 2), (2, "b", 1)]
    assert held() == 0


def test_timers_need_a_stream(spark):
    with pytest.raises(ValueError):
        top_n_by_timer(spark.createDataFrame([], "window_end timestamp, itemId long, view_count long"), 3)


# --- totals ------------------------------------------------------------------------------------------


def _totals(spark, store):
    return {r.word: r.cnt for r in read_totals(spark, store, ["word"]).collect()}


def test_totals_are_folded_while_they_are_read(spark, folder):
    store, sink = f"{folder}/store", batch_folder_sink(f"{folder}/store/deltas")

    def change(batch_id, **counts):
        sink(spark.createDataFrame(list(counts.items()), "word string, cnt long"), batch_id)

    change(0, a=1, b=1)
    commit_batch(spark, f"{store}/commits", 0)
    change(1, a=2, c=1)
    commit_batch(spark, f"{store}/commits", 1)
    reader = read_totals(spark, store, ["word"])  # of the state before the fold
    assert fold_totals(spark, store, ["word"]) and not fold_totals(spark, store, ["word"])
    assert manifest(spark, store)["upto"] == 1
    assert {r.word: r.cnt for r in reader.collect()} == _totals(spark, store) == {"a": 2, "b": 1, "c": 1}
    change(2, a=9)
    assert _totals(spark, store)["a"] == 2  # written, but not complete
    commit_batch(spark, f"{store}/commits", 2)
    assert _totals(spark, store) == {"a": 9, "b": 1, "c": 1}
    remove_folded(spark, store)
    assert sorted(n for n in os.listdir(f"{store}/deltas") if n.startswith("batch")) == ["batch_id=2"]
    assert _totals(spark, store) == {"a": 9, "b": 1, "c": 1}
    assert fold_totals(spark, store, ["word"])
    remove_folded(spark, store)
    assert len(published(spark, f"{store}/snapshots")) == 1
    assert _totals(spark, store) == {"a": 9, "b": 1, "c": 1}


def test_folds_at_the_same_time_give_one_state(spark, folder):
    store, sink = f"{folder}/store", batch_folder_sink(f"{folder}/store/deltas")
    for n in range(4):
        sink(spark.createDataFrame([("a", n), (f"w{n}", 1)], "word string, cnt long"), n)
        commit_batch(spark, f"{store}/commits", n)
    found = []
    threads = [threading.Thread(target=lambda: found.append(fold_totals(spark, store, ["word"]))) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert any(found) and manifest(spark, store)["upto"] == 3
    assert _totals(spark, store) == {"a": 3, **{f"w{n}": 1 for n in range(4)}}


def test_message_totals_command(spark, folder, capsys):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.txt", "w", encoding="utf-8") as out:
        out.write("A\nb\na\n")
    main(["message-counts", "--totals", "--files", f"{folder}/in", "--output", f"{folder}/t", "--once", "--checkpoint", f"{folder}/s"])
    main(["fold-counts", "--store", f"{folder}/t", "--remove"])
    main(["fold-counts", "--store", f"{folder}/t"])
    assert capsys.readouterr().out == "folded\nnothing to fold\n"
    assert _totals(spark, f"{folder}/t") == {"a": 2, "b": 1}


# --- several sinks -----------------------------------------------------------------------------------


def test_publishing(spark, folder):
    assert published(spark, f"{folder}/none") == [] and last_commit(spark, f"{folder}/none") == -1
    assert publish(spark, f"{folder}/m", "1", "é") and not publish(spark, f"{folder}/m", "1", "other")
    assert published(spark, f"{folder}/m") == ["1"] and read_published(spark, f"{folder}/m", "1") == "é"


def test_a_batch_is_visible_in_all_sinks_or_in_none(spark, folder):
    lines = [('{"pos":1000,"RAWID":"r"}', 0), ("broken", 1), ('{"pos":2000,"RAWID":"s"}', 10), ("", 11)]
    df = spark.createDataFrame(lines, "value string, position long")
    attempts = []

    def killed(batch, batch_id):
        attempts.append(batch_id)
        if attempts == [0, 1]:
            raise RuntimeError("killed between two sinks")

    def start(raw):
        return topic_records.start_records_and_rejects(
            raw, STATE_EVENTS, f"{folder}/out", checkpoint=f"{folder}/state", pattern="yyyy-MM-dd", more=[killed]
        )

    def visible():
        records = topic_records.read_records(spark, STATE_EVENTS, f"{folder}/out").collect()
        refused = topic_records.read_rejects(spark, f"{folder}/out", "value string, position long").collect()
        return sorted(r.id for r in records), sorted(r.reject_reason for r in refused)

    with pytest.raises(Exception, match="killed"):
        run_in_stages(df, "position", 2, f"{folder}/feed", start)
    assert os.path.isdir(f"{folder}/out/records/batch_id=1")  # stored, but not visible
    assert visible() == (["r"], ["malformed_json"])
    start(spark.readStream.schema(df.schema).parquet(f"{folder}/feed/stage-*")).awaitTermination()
    assert attempts == [0, 1, 1]
    assert visible() == (["r", "s"], ["empty_message", "malformed_json"])


def test_at_once_command(spark, folder, capsys):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.txt", "w", encoding="utf-8") as out:
        out.write('{"pos":1000,"RAWID":"r"}\nbroken\n')
    main([
        "state-events", "--at-once", "--files", f"{folder}/in", "--output", f"{folder}/out", "--format", "text", "--once",
        "--checkpoint", f"{folder}/state",
    ])
    assert "1000\tr\tNull" in capsys.readouterr().out
    assert [r.id for r in topic_records.read_records(spark, STATE_EVENTS, f"{folder}/out", "text").collect()] == ["r"]
    assert [r.value for r in topic_records.read_rejects(spark, f"{folder}/out").collect()] == ["broken"]


# --- compaction --------------------------------------------------------------------------------------


def test_files_roll_by_measured_bytes(spark, folder, capsys):
    rows = spark.range(8_000).select(F.sha2(F.col("id").cast("string"), 256).alias("value"), F.lit("2024").alias("bucket"))
    write_bucketed(rows.repartition(16), f"{folder}/in", gather=False)
    total = bucket_files(spark, f"{folder}/in").agg(F.sum("length")).first()[0]

    def written(path):
        files = bucket_files(spark, path).count()
        return files, sorted(r.value for r in read_bucketed(spark, path, rows.schema).collect())

    expected = sorted(r.value for r in rows.collect())
    for k in (1, 2, 5):
        done = compact_buckets(spark, f"{folder}/in", f"{folder}/k{k}", rows.schema, roll_bytes=-(-total // k), manifests=f"{folder}/m{k}")
        assert done == ["2024"] and written(f"{folder}/k{k}") == (k, expected)
        assert compact_buckets(spark, f"{folder}/in", f"{folder}/k{k}", rows.schema, manifests=f"{folder}/m{k}") == []
    # rows go by their files alone: a second run writes the same files
    def content(path):
        files = spark.read.schema("value string, bucket string").parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("sum"))
        return sorted(r["sum"] for r in files.collect())

    compact_buckets(spark, f"{folder}/in", f"{folder}/again", rows.schema, roll_bytes=-(-total // 5))
    assert content(f"{folder}/again") == content(f"{folder}/k5")
    main(["compact", "--input", f"{folder}/in", "--output", f"{folder}/cli", "--roll-bytes", str(total), "--manifests", f"{folder}/mc"])
    main(["compact", "--input", f"{folder}/in", "--output", f"{folder}/cli", "--manifests", f"{folder}/mc"])
    assert capsys.readouterr().out == "1 buckets written\n0 buckets written\n"
    assert written(f"{folder}/cli") == (1, expected)


def test_word_windows_are_stored_once(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.txt", "w", encoding="utf-8") as out:
        out.write("x y x\n")
    main(["word-counts", "--files", f"{folder}/in", "--once", "--checkpoint", f"{folder}/state", "--output", f"{folder}/out", "--window", "1 second"])
    assert os.path.isdir(f"{folder}/out")
    main(["word-counts", "--files", f"{folder}/in", "--once", "--checkpoint", f"{folder}/state2", "--closed"])
