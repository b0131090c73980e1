"""Behaviour logs: header-less CSV with a fixed field order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from windrow.schemas import USER_BEHAVIOR

CORRUPT = "corrupt_record"


def read_behavior_csv(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    schema: StructType = USER_BEHAVIOR,
    on_bad_row: str = "fail",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Read `path` (a file or folder; a folder when streaming) into typed columns.

    `on_bad_row`: `fail` stops the job at the first malformed row, `keep` leaves the raw line of
    such rows in the column `corrupt_record` (null for good rows). Spark converts
    only the fields that a query uses, so only those are checked.
    """
    if on_bad_row not in ("fail", "keep"):
        raise ValueError("on_bad_row must be 'fail' or 'keep'")
    reader = spark.readStream if streaming else spark.read
    if on_bad_row == "fail":
        reader = reader.schema(schema).option("mode", "FAILFAST")
    else:
        kept = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        reader = reader.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.option("header", "false").format("csv").load(path)
