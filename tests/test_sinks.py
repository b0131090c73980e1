import datetime
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from windrow.schemas import PASSING_RECORD
from windrow.sinks.buckets import read_bucketed, with_bucket, write_bucketed
from windrow.sinks.compaction import bucket_files, compact_buckets


def _records(spark, days=(1, 2), per_day=5):
    rows = [
        (str(1000 * d + i), f"P{i}" if i else None, datetime.datetime(2024, 1, d, 12, i))
        for d in days for i in range(per_day)
    ]
    return spark.createDataFrame(rows, "passingTime string, plateNo string, event_time timestamp")


def _stored(df):
    return sorted(map(tuple, df.select("passingTime", "bucket").collect()))


def _files(path):
    return {
        d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.startswith("part-"))
        for d in os.listdir(path) if d.startswith("bucket=")
    }


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_folder_names_and_rows(spark, folder, fmt):
    df = with_bucket(_records(spark), pattern="yyyy-MM-dd--HHmm").drop("event_time")
    write_bucketed(df, f"{folder}/out", fmt)
    assert "bucket=2024-01-01--2003" in _files(f"{folder}/out")
    assert _stored(read_bucketed(spark, f"{folder}/out", PASSING_RECORD, fmt)) == _stored(df)


def test_days_stay_text(spark, folder):
    df = with_bucket(_records(spark), pattern="yyyy-MM-dd").drop("event_time")
    write_bucketed(df, f"{folder}/out")
    back = read_bucketed(spark, f"{folder}/out", PASSING_RECORD)
    assert dict(back.dtypes)["bucket"] == "string"
    assert _stored(back) == _stored(df)


def test_records_become_json_lines_with_their_nulls(spark, folder):
    df = with_bucket(_records(spark, days=(1,), per_day=1), pattern="yyyy-MM-dd").drop("event_time")
    write_bucketed(df, f"{folder}/out", "text")
    row = read_bucketed(spark, f"{folder}/out", PASSING_RECORD, "text").first()
    assert json.loads(row.value) == {"passingTime": "1000", "plateNo": None}


def test_plain_messages_stay_as_they_are(spark, folder):
    df = spark.createDataFrame([("a", "b1"), ("", "b1"), ("x,y", "b2")], "value string, bucket string")
    write_bucketed(df, f"{folder}/out", "text")
    back = read_bucketed(spark, f"{folder}/out", df.schema, "text")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_overwrite_replaces_only_the_buckets_written(spark, folder):
    path = f"{folder}/out"
    write_bucketed(with_bucket(_records(spark), pattern="yyyy-MM-dd").drop("event_time"), path)
    again = with_bucket(_records(spark, days=(2,), per_day=1), pattern="yyyy-MM-dd").drop("event_time")
    write_bucketed(again, path, mode="overwrite")
    stored = read_bucketed(spark, path, PASSING_RECORD)
    assert {r.bucket: r["count"] for r in stored.groupBy("bucket").count().collect()} == {
        "2024-01-01": 5, "2024-01-02": 1,
    }


def test_gathering_is_optional(spark, folder):
    df = with_bucket(_records(spark), pattern="yyyy-MM-dd").drop("event_time").repartition(4)
    write_bucketed(df, f"{folder}/gathered")
    write_bucketed(df, f"{folder}/scattered", gather=False)
    assert [len(f) for f in _files(f"{folder}/gathered").values()] == [1, 1]
    assert max(len(f) for f in _files(f"{folder}/scattered").values()) > 1
    assert _stored(read_bucketed(spark, f"{folder}/scattered", PASSING_RECORD)) == _stored(df)


def test_writer_clock(spark):
    df = with_bucket(_records(spark), time=None, pattern="yyyy", zone="UTC")
    assert {r.bucket for r in df.collect()} == {str(datetime.datetime.now(datetime.timezone.utc).year)}


def test_writer_clock_of_a_repeated_batch(spark, folder):
    """A micro-batch that fails and runs again, by a new query, has the buckets of its first run."""
    spark.createDataFrame([("a",)], "value string").write.text(f"{folder}/in")
    seen = []

    def start(fails):
        lines = spark.readStream.schema("value string").text(f"{folder}/in")
        bucketed = with_bucket(lines, time=None, pattern="yyyy-MM-dd HH:mm:ss.SSS", zone="UTC")

        def sink(batch, batch_id):
            seen.append((batch_id, [r.bucket for r in batch.collect()]))
            if fails:
                raise RuntimeError("lost")

        return bucketed.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()

    with pytest.raises(StreamingQueryException):
        start(True).awaitTermination()
    start(False).awaitTermination()
    assert len(seen) == 2 and len(seen[0][1]) == 1 and seen[0] == seen[1]


def test_unknown_format(spark, folder):
    with pytest.raises(ValueError):
        write_bucketed(with_bucket(_records(spark)), f"{folder}/out", "xml")


def test_compaction(spark, folder):
    source, target = f"{folder}/scattered", f"{folder}/compact"
    big = spark.range(20_000).select(
        F.format_string("%020d", "id").alias("passingTime"), F.sha2(F.col("id").cast("string"), 256).alias("plateNo"),
        F.when(F.col("id") < 19_000, "big").otherwise("small").alias("bucket"),
    )
    for part in range(3):
        big.filter(F.col("id") % 3 == part).repartition(4).write.mode("append").partitionBy("bucket").parquet(source)
    assert {d: len(f) for d, f in _files(source).items()} == {"bucket=big": 12, "bucket=small": 12}
    length = bucket_files(spark, source).filter("bucket = 'big'").agg(F.sum("length")).first()[0]

    compact_buckets(spark, source, target, PASSING_RECORD, roll_bytes=length // 3 + 1)
    files = {d: len(f) for d, f in _files(target).items()}
    assert files["bucket=small"] == 1
    assert 1 < files["bucket=big"] <= 3
    assert _stored(read_bucketed(spark, target, PASSING_RECORD)) == _stored(read_bucketed(spark, source, PASSING_RECORD))

    # once more, one bucket only: same rows, nothing twice
    compact_buckets(spark, source, target, PASSING_RECORD, buckets=["small"])
    assert _stored(read_bucketed(spark, target, PASSING_RECORD)) == _stored(read_bucketed(spark, source, PASSING_RECORD))


def test_compaction_of_text(spark, folder):
    lines = spark.createDataFrame([(f"line {i}", "b") for i in range(100)], "value string, bucket string")
    lines.repartition(8).write.partitionBy("bucket").text(f"{folder}/in")
    compact_buckets(spark, f"{folder}/in", f"{folder}/out", lines.schema, "text")
    assert len(_files(f"{folder}/out")["bucket=b"]) == 1
    assert read_bucketed(spark, f"{folder}/out", lines.schema, "text").count() == 100
