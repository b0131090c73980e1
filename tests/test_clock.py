import datetime

import pytest
from pyspark.sql import functions as F

from windrow.functions import clock
from windrow.operators.event_time import with_event_time


def test_durations():
    assert clock.duration_micros("5 minutes") == 300_000_000
    assert clock.duration_micros("1 hour 30 seconds") == 3_630_000_000
    assert clock.duration_micros(datetime.timedelta(milliseconds=1)) == 1_000
    for bad in ("", "5", "5 moons", "0 seconds"):
        with pytest.raises(ValueError):
            clock.duration_micros(bad)


@pytest.mark.parametrize(
    "millis, text",
    [
        (1_704_067_200_000, "2024-01-01 00:00:00.0"),
        (1_704_067_200_100, "2024-01-01 00:00:00.1"),
        (1_704_067_200_250, "2024-01-01 00:00:00.25"),
        (1_704_067_200_001, "2024-01-01 00:00:00.001"),
        (1_704_067_210_000, "2024-01-01 00:00:10.0"),
    ],
)
def test_timestamp_text(spark, millis, text):
    df = spark.range(1).select(clock.jdbc_timestamp_text(F.timestamp_millis(F.lit(millis))).alias("t"))
    assert df.first().t == text


def test_zone(spark):
    time = F.timestamp_seconds(F.lit(1_704_067_200))
    row = spark.range(1).select(
        clock.zoned_text(time, "yyyy-MM-dd--HHmm", "Asia/Shanghai").alias("a"),
        clock.zoned_text(time, "yyyy-MM-dd", "America/New_York").alias("b"),
    ).first()
    assert tuple(row) == ("2024-01-01--0800", "2023-12-31")


def test_zone_needs_a_utc_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        with pytest.raises(ValueError):
            clock.zoned_text(F.current_timestamp(), "yyyy", "UTC")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_floor_before_1970(spark):
    df = spark.createDataFrame([(-1,), (-10,), (-11,), (0,), (9,), (10,)], "t bigint")
    assert [r[0] for r in df.select(clock.floor_to(F.col("t"), 10)).collect()] == [-10, -10, -20, 0, 0, 10]


def test_event_time_units(spark):
    df = spark.createDataFrame([(1_704_067_200,)], "t bigint")
    for unit, factor in (("s", 1), ("ms", 1_000), ("us", 1_000_000)):
        timed = with_event_time(df.select((F.col("t") * factor).alias("t")), "t", unit)
        assert timed.first().event_time == datetime.datetime(2024, 1, 1)
    with pytest.raises(ValueError):
        with_event_time(df, "t", "days")
