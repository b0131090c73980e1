"""Few large files instead of many small ones."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from windrow.constants import ROLL_BYTES
from windrow.operators.small_side import broadcast_if_small
from windrow.sinks.buckets import BUCKET, read_bucketed
from windrow.sinks.commits import publish, published, read_published


def bucket_files(spark: SparkSession, path: str) -> DataFrame:
    """`bucket, path, length` of the data files; file contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col(BUCKET).cast("string").alias(BUCKET), F.col("_metadata.file_path").alias("path"), "length")


def packed_files(files: DataFrame) -> DataFrame:
    """Add `before`: the bytes of the bucket's files in front of a file, in order of their paths."""
    earlier = W.partitionBy(BUCKET).orderBy("path").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("length").over(earlier), F.lit(0)))


def compact_buckets(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    fmt: str = "parquet",
    *,
    roll_bytes: int = ROLL_BYTES,
    buckets: Sequence[str] | None = None,
    manifests: str | None = None,
) -> list[str]:
    """Rewrite buckets of `source` into `target` with files of about `roll_bytes`; returns the buckets written.

    A streaming sink closes a file per task and micro-batch; run this on buckets that no longer
    grow. The files of a bucket are laid end to end, by their measured sizes, and cut every `roll_bytes`: small files go
    together, and a bucket of k times `roll_bytes` becomes k files written by k tasks, so a huge bucket is no
    bottleneck. Where a row goes depends on its file and its block of that file alone, so a task that is run again puts
    the same rows into the same files. A block is what one task reads (`spark.sql.files.maxPartitionBytes`); nothing
    smaller is cut.

    The source is left as it is, and a repeated run replaces what it wrote before. With `manifests`, a folder, each
    run says there which files it folded, and a bucket whose files are those of the last run is passed over.
    """
    files = packed_files(bucket_files(spark, source))
    if buckets is not None:
        files = files.filter(F.col(BUCKET).isin(list(buckets)))
    # the files of a bucket in one number: nothing grows with the files but the sum
    seen = F.sum(F.xxhash64("path", "length").cast("decimal(38,0)")).cast("string")
    state = files.groupBy(BUCKET).agg(F.sum("length").alias("bytes"), seen.alias("files")).collect()  # a row per bucket
    known = _folded(spark, manifests) if manifests else {}
    new = {r[BUCKET]: r for r in state if known.get(r[BUCKET]) != r["files"]}
    if not new:
        return []
    places = broadcast_if_small(
        files.filter(F.col(BUCKET).isin(list(new))).select(F.col("path").alias("_path"), F.col("before").alias("_before"))
    )
    total = sum(r["bytes"] for r in new.values())
    # at least as many tasks as the largest bucket has parts, so no task writes two of its parts
    tasks = max(math.ceil(total / roll_bytes), spark.sparkContext.defaultParallelism)
    rows = read_bucketed(spark, source, schema, fmt).filter(F.col(BUCKET).isin(list(new)))
    columns = rows.columns
    at = F.col("_before") + F.col("_start")
    task = F.pmod(F.xxhash64(BUCKET) + F.floor(at / F.lit(roll_bytes)), F.lit(tasks)).cast("int")
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    (
        placed.join(places, F.col("_file") == F.col("_path"))
        .withColumn("_task", task)
        .repartitionById(tasks, "_task")
        .select(*columns)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .save(target)
    )
    if manifests:
        number = len(published(spark, manifests))
        publish(spark, manifests, f"{number:012d}", json.dumps({**known, **{b: r["files"] for b, r in new.items()}}))
    return sorted(new)


def _folded(spark: SparkSession, manifests: str) -> dict[str, str]:
    names = published(spark, manifests)
    return json.loads(read_published(spark, manifests, names[-1])) if names else {}
