"""Folders by time bucket, in Parquet, JSON or text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from windrow.constants import BUCKET_ZONE, MINUTE_BUCKET
from windrow.functions.clock import zoned_text
from windrow.operators.event_time import EVENT_TIME

BUCKET = "bucket"
FORMATS = ("parquet", "json", "text")


def with_bucket(
    df: DataFrame,
    *,
    time: str | None = EVENT_TIME,
    pattern: str = MINUTE_BUCKET,
    zone: str = BUCKET_ZONE,
) -> DataFrame:
    """Add `bucket`: the record's time on the wall clock of `zone`.

    `time=None` takes the clock of the writing query instead of the record's own time. On a stream
    that is the time at which its micro-batch was planned, which stands in the checkpoint: a micro-batch that
    runs again after a restart, be it past midnight, has the buckets it had before. Add the column to the
    stream, not in a function of its micro-batches. Data read again from the start get new buckets.
    """
    instant = F.col(time) if time else F.current_timestamp()
    return df.withColumn(BUCKET, zoned_text(instant, pattern, zone))


def as_lines(df: DataFrame) -> DataFrame:
    """`value, bucket`: the value itself where it is the only field, else the record as JSON."""
    fields = [name for name in df.columns if name != BUCKET]
    if fields == ["value"]:
        return df
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(record.alias("value"), BUCKET)


def encoded(df: DataFrame, fmt: str) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    return as_lines(df) if fmt == "text" else df


def write_bucketed(
    df: DataFrame, path: str, fmt: str = "parquet", *, mode: str = "append", gather: bool = True
) -> None:
    """Write a bounded table with a `bucket` column into one folder per bucket.

    Rows are gathered by bucket so that a bucket is not scattered over as many files as there are
    tasks; adaptive execution splits a bucket that is too big for one task and merges small ones.
    With `gather=False` each task writes the rows it has, without a shuffle: the better choice for
    input whose files are already in order of time, where a task meets few buckets.
    `mode="overwrite"` replaces only the buckets present in `df`.
    """
    rows = encoded(df, fmt)
    (
        (rows.hint("rebalance", BUCKET) if gather else rows)
        .write.format(fmt)
        .mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .save(path)
    )


def read_bucketed(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Read such folders back; the bucket stays text (a day would otherwise become a date)."""
    fields = [field for field in schema.fields if field.name != BUCKET]
    if fmt == "text":
        fields = [StructField("value", StringType())]
    return spark.read.schema(StructType([*fields, StructField(BUCKET, StringType())])).format(fmt).load(path)
