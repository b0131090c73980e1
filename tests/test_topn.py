import datetime
import random

import pytest
from pyspark.sql import functions as F

from windrow.operators.topn import render_report, top_n_per_window

SCHEMA = "window_end timestamp, itemId bigint, view_count bigint"


def _at(minute):
    return datetime.datetime(2024, 1, 1, 1, minute)


def _top(spark, rows, n):
    top = top_n_per_window(spark.createDataFrame(rows, SCHEMA), n).orderBy("window_end", "rank")
    return [tuple(r) for r in top.collect()]


def test_ties_and_short_windows(spark):
    rows = [(_at(0), 5, 1), (_at(0), 4, 1), (_at(0), 9, 7), (_at(0), 1, 1), (_at(5), 3, 2)]
    assert _top(spark, rows, 3) == [
        (_at(0), 9, 7, 1), (_at(0), 1, 1, 2), (_at(0), 4, 1, 3), (_at(5), 3, 2, 1),
    ]
    assert _top(spark, rows[:2], 2) == [(_at(0), 4, 1, 1), (_at(0), 5, 1, 2)]
    assert _top(spark, [], 3) == []


def test_counts_beyond_32_bits(spark):
    assert [r[1] for r in _top(spark, [(_at(0), 1, 1), (_at(0), 2, 2**40), (_at(0), 3, 2**33)], 3)] == [2, 3, 1]


@pytest.mark.parametrize("limit", [1000, 2])
def test_many_ranks_with_and_without_the_cutting_pass(spark, limit):
    rng = random.Random(1)
    rows = [(_at(w), item, rng.randrange(20)) for w in (0, 5) for item in range(300)]
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, str(limit))
    try:
        got = _top(spark, rows, 50)
    finally:
        spark.conf.set(key, before)
    expected = []
    for w in (0, 5):
        best = sorted((r for r in rows if r[0] == _at(w)), key=lambda r: (-r[2], r[1]))[:50]
        expected += [(*r, i + 1) for i, r in enumerate(best)]
    assert got == expected


def test_any_number_of_ranks(spark):
    """One large window, half of it ties, beside small ones, a null window and null scores, over many ranges."""
    from pyspark.sql import Window as W

    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    ids = spark.range(30_000).withColumn("w", F.when(F.col("id") % 10 < 8, 0).when(F.col("id") % 10 < 9, F.col("id") % 40))
    score = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id"), F.lit(1000)))
    rows = ids.select(F.timestamp_seconds("w").alias("window_end"), F.col("id").alias("itemId"), score.alias("view_count")).repartition(7)
    order = W.partitionBy("window_end").orderBy(F.col("view_count").desc(), F.col("itemId"))
    plain = rows.withColumn("rank", F.row_number().over(order).cast("bigint")).filter("rank <= 5000")
    spark.conf.set(key, "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = top_n_per_window(rows, 5000)
        assert got.schema["rank"].dataType.simpleString() == "bigint" and got.columns == plain.columns
        large = got.filter("window_end = timestamp_seconds(0)")
        assert large.count() == 5000 and large.select(F.spark_partition_id()).distinct().count() > 1
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert top_n_per_window(rows.limit(0), 5000).count() == 0


def test_report_text(spark):
    rows = [(_at(5), 10, 8), (_at(5), 7, 3)]
    top = top_n_per_window(spark.createDataFrame(rows, SCHEMA), 3)
    rule = "=" * 37
    assert render_report(top, zone="Asia/Shanghai").first().report == (
        f"{rule}\n时间： 2024-01-01 09:05:00.0\n"
        "No0:  商品ID=10  浏览量=8\nNo1:  商品ID=7  浏览量=3\n"
        f"{rule}\n\n"
    )


def test_report_orders_ten_and_more_ranks_by_number(spark):
    rows = [(_at(0), i, 100 - i) for i in range(12)]
    report = render_report(top_n_per_window(spark.createDataFrame(rows, SCHEMA), 12)).first().report
    assert [line.split(":")[0] for line in report.split("\n") if line.startswith("No")] == [f"No{i}" for i in range(12)]


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load().select(
        F.col("timestamp").alias("window_end"), F.col("value").alias("itemId"), F.col("value").alias("view_count")
    )
    with pytest.raises(ValueError):
        top_n_per_window(stream, 3)
