"""Small files that appear whole or not at all, and say what else is visible.

A file is written under a hidden name and then renamed. Only the driver does this, with a few bytes; the data that a file
speaks of were written by tasks before. Any file system that Spark writes to will do.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def publish(spark: SparkSession, folder: str, name: str, text: str = "") -> bool:
    """Put a file into `folder` in one step; False if there is one of this name already, which then stays."""
    fs, target = _file_system(spark, f"{folder}/{name}")
    if fs.exists(target):
        return False
    hidden = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    return bool(fs.rename(hidden, target))


def published(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in `folder`, sorted."""
    fs, place = _file_system(spark, folder)
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(name for name in names if not name.startswith((".", "_")))


def read_published(spark: SparkSession, folder: str, name: str) -> str:
    fs, place = _file_system(spark, f"{folder}/{name}")
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def commit_batch(spark: SparkSession, commits: str, batch_id: int) -> None:
    """Make a micro-batch visible in all its sinks at once. A repeated one is visible already."""
    publish(spark, commits, f"{batch_id:012d}")


def last_commit(spark: SparkSession, commits: str) -> int:
    """The last visible micro-batch, -1 before the first. Micro-batches end in order, so all before it are visible too."""
    names = published(spark, commits)
    return int(names[-1]) if names else -1


def read_committed(spark: SparkSession, path: str, commits: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """What the folders `batch_id=<n>` below `path` hold of visible micro-batches; `schema` names the columns, `batch_id` too."""
    return spark.read.schema(schema).format(fmt).load(path).filter(F.col("batch_id") <= last_commit(spark, commits))
