import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from windrow.operators.counts import running_count, sliding_count, tumbling_count, windowed_count
from windrow.operators.release import window_release

EPOCH = datetime.datetime(1970, 1, 1)


def _timed(spark, rows):
    df = spark.createDataFrame(rows, "k string, ms bigint")
    return df.withColumn("event_time", F.timestamp_millis("ms"))


def _brute(rows, size, slide):
    """Windows start at multiples of the slide."""
    counted = Counter()
    for key, ms in rows:
        start = ms - ms % slide
        while start + size > ms:
            counted[(key, EPOCH + datetime.timedelta(milliseconds=start + size))] += 1
            start -= slide
    return counted


@pytest.mark.parametrize("size, slide", [(60, 5), (10, 10), (10, 3), (7, 7), (60, 60), (10, 4), (4, 10), (9, 6)])
def test_counts_against_brute_force(spark, size, slide):
    rng = random.Random(size * 100 + slide)
    rows = [(rng.choice("abc") if rng.random() < 0.7 else "hot", rng.randrange(-50_000, 200_000)) for _ in range(500)]
    counted = windowed_count(_timed(spark, rows), "k", f"{size} seconds", f"{slide} seconds")
    got = {(r.k, r.window_end): r.cnt for r in counted.collect()}
    assert got == dict(_brute(rows, size * 1000, slide * 1000))
    bounds = counted.select((F.unix_seconds("window_end") - F.unix_seconds("window_start")).alias("d")).distinct()
    assert [r.d for r in bounds.collect()] == [size]


def test_boundaries(spark):
    rows = [("a", 9_999), ("a", 10_000), ("a", 19_999), ("a", 20_000)]
    counted = tumbling_count(_timed(spark, rows), "k", "10 seconds").orderBy("window_end")
    assert [r.cnt for r in counted.collect()] == [1, 2, 1]


def test_null_time_is_in_no_window_and_null_key_is_a_key(spark):
    rows = [("a", None), (None, 1_000), (None, 2_000)]
    assert [(r.k, r.cnt) for r in tumbling_count(_timed(spark, rows), "k", "10 seconds").collect()] == [(None, 2)]


def test_sum_of_a_column(spark):
    rows = [("a", 1_000), ("a", 6_000), ("b", 11_000)]
    summed = sliding_count(_timed(spark, rows), ["k"], "10 seconds", "5 seconds", value="ms", name="total")
    got = {(r.k, (r.window_end - EPOCH).total_seconds()): r.total for r in summed.collect()}
    assert got == {
        ("a", 5.0): 1_000, ("a", 10.0): 7_000, ("a", 15.0): 6_000, ("b", 15.0): 11_000, ("b", 20.0): 11_000,
    }


def test_running_count(spark):
    df = spark.createDataFrame([("a", 2), ("b", 3), ("a", 5)], "k string, v int")
    assert {r.k: r.cnt for r in running_count(df, "k").collect()} == {"a": 2, "b": 1}
    assert {r.k: r.s for r in running_count(df, "k", value="v", name="s").collect()} == {"a": 7, "b": 3}


def test_release_of_bounded_input_keeps_every_record(spark):
    rows = [("a", 9_999), ("a", 9_999), ("b", 10_000)]
    released = window_release(_timed(spark, rows), "10 seconds").orderBy("window_end", "k").collect()
    assert [(r.k, r.ms, (r.window_end - EPOCH).total_seconds()) for r in released] == [
        ("a", 9_999, 10.0), ("a", 9_999, 10.0), ("b", 10_000, 20.0),
    ]
