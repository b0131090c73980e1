"""The replayed watermark against a plain loop over the arrivals."""

import math
import random

import pytest
from pyspark.sql import functions as F

from windrow.operators import small_side
from windrow.operators.lateness import late_audit, on_time_records, punctuated_watermark
from windrow.operators.ordering import LEVEL_BLOCK, ROW_BLOCK, TOP_ROWS, blocks_for, running_before, with_arrival_position

SIZE = 1_000


def _arrivals(seed, n, spread, low=0):
    rng = random.Random(seed)
    positions = rng.sample(range(n * 50), n)
    rows = []
    for i, position in enumerate(sorted(positions)):
        ms = low + i * 100 + rng.randrange(-spread, spread + 1)
        if rng.random() < 0.1:
            ms = ms - ms % SIZE + SIZE - 1  # the last millisecond of a window
        rows.append((position, ms, rng.choice(["p0", "p1", None])))
    rng.shuffle(rows)
    return rows


def _replay(rows, by_source):
    """position -> (watermark before, watermark after, late)"""
    marks, result = {}, {}
    for position, ms, source in sorted(rows):
        key = source if by_source else None
        before = marks.get(key)
        end = ms - ms % SIZE + SIZE
        marks[key] = max(before or 0, ms)
        result[position] = (before, marks[key], before is not None and end - 1 <= before)
    return result


def _frame(spark, rows):
    df = spark.createDataFrame(rows, "position bigint, ms bigint, source string")
    return df.withColumn("event_time", F.timestamp_millis("ms"))


CASES = [(1, 400, 900, 0), (2, 400, 5_000, 0), (3, 300, 3_000, -15_000), (4, 50, 0, 0), (5, 1, 0, 0)]


@pytest.mark.parametrize("by", [[], ["source"]])
@pytest.mark.parametrize("seed, n, spread, low", CASES)
def test_audit(spark, seed, n, spread, low, by):
    rows = _arrivals(seed, n, spread, low)
    audited = late_audit(_frame(spark, rows), "position", "1 second", by=by).collect()
    expected = _replay(rows, bool(by))
    assert {r.position: r.is_late for r in audited} == {p: late for p, (_, _, late) in expected.items()}
    assert len(audited) == n


@pytest.mark.parametrize("by", [[], ["source"]])
@pytest.mark.parametrize("blocks", [(1 << 20, 1 << 12), (7, 3), (16,), (5, 2, 2), None])
def test_watermark(spark, by, blocks):
    rows = _arrivals(6, 300, 2_000, -3_000)
    replayed = punctuated_watermark(_frame(spark, rows), "position", by=by, blocks=blocks).collect()
    expected = _replay(rows, bool(by))
    assert {r.position: (r.watermark_before, r.watermark_after) for r in replayed} == {
        p: (before, after) for p, (before, after, _) in expected.items()
    }


def test_large_window_table_is_joined_by_shuffling(spark, monkeypatch):
    monkeypatch.setattr(small_side, "MAX_BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = _arrivals(7, 300, 4_000)
        audited = late_audit(_frame(spark, rows), "position", "1 second", by=["source"])
        assert {r.position: r.is_late for r in audited.collect()} == {
            p: late for p, (_, _, late) in _replay(rows, True).items()
        }
        assert "SortMergeJoin" in audited._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_on_time(spark):
    rows = _arrivals(8, 200, 3_000)
    kept = on_time_records(_frame(spark, rows), "position", "1 second")
    assert "is_late" not in kept.columns
    assert {r.position for r in kept.collect()} == {p for p, (_, _, late) in _replay(rows, False).items() if not late}


def test_window_lengths_are_whole_milliseconds(spark):
    with pytest.raises(ValueError):
        late_audit(_frame(spark, [(0, 0, "p")]), "position", "1500 microseconds")


def test_arrival_position_from_any_order(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(5), i, rng.randrange(10_000)) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, v bigint").repartition(6)
    numbered = with_arrival_position(df, "a", F.col("b").desc())
    order = [(r.a, r.b) for r in numbered.orderBy("position").collect()]
    assert order == sorted(((a, b) for a, b, _ in rows), key=lambda t: (t[0], -t[1]))
    assert numbered.select("position").distinct().count() == 500
    low = running_before(numbered, "position", "v", "min", name="low", blocks=(1 << 10, 4))
    best, expected = None, {}
    for a, b, v in sorted(rows, key=lambda t: (t[0], -t[1])):
        expected[b] = best
        best = v if best is None else min(best, v)
    assert {r.b: r.low for r in low.collect()} == expected


def test_broadcast_goes_by_the_counted_size(spark):
    table = spark.range(1_000).select("id", F.lit("x" * 100).alias("text"))
    assert small_side.fits_broadcast(table, 1_000 * (64 + 16 + 100))
    assert not small_side.fits_broadcast(table, 1_000 * (64 + 16 + 100) - 1)
    hinted = small_side.broadcast_if_small(table)
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    plain = small_side.broadcast_if_small(table, 10)
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        late_audit(stream, "value", "1 second", time="timestamp")


def test_records_without_a_time_are_in_no_window(spark):
    from windrow.operators.release import window_release

    rows = [(0, None), (1, 5_000), (2, None), (3, 4_000)]
    df = spark.createDataFrame(rows, "position long, ms long").withColumn("event_time", F.timestamp_millis("ms"))
    kept = on_time_records(df, "position", "10 seconds").select("position", "window_start", "window_end")
    released = window_release(df, "10 seconds").select("position", "window_start", "window_end")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, released.collect()))
    assert late_audit(df, "position", "10 seconds").count() == 4


def test_levels_follow_the_positions(spark):
    def levels(*positions):
        return blocks_for(spark.createDataFrame([(p,) for p in positions], "position long"), "position")

    assert levels() == levels(5) == levels(-3, 1 << 30) == [ROW_BLOCK]
    year = 365 * 86_400 * 10**9
    for low, high in [(0, 1 << 40), (7, year), (-year, year), (-(1 << 62), 1 << 62)]:
        covered = math.prod(found := levels(low, high))
        assert (high - low) // covered < TOP_ROWS <= ((high - low) // (covered // LEVEL_BLOCK)) + 2
        assert found[0] == ROW_BLOCK and set(found[1:]) == {LEVEL_BLOCK}


def test_sparse_positions(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(365 * 86_400 * 10**9), rng.randrange(10_000)) for _ in range(300)]
    found = running_before(spark.createDataFrame(rows, "position long, v long"), "position", "v", "max", name="high")
    best, expected = None, {}
    for position, v in sorted(rows):
        expected[position] = best
        best = v if best is None else max(best, v)
    assert {r.position: r.high for r in found.collect()} == expected
