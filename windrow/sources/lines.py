"""Text lines, and tables read as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a text socket as `value, timestamp` (arrival time). Cannot be replayed, so a query
    on it does not survive a restart: for trying things out only."""
    return (
        spark.readStream.format("socket")
        .option("host", host)
        .option("port", port)
        .option("includeTimestamp", "true")
        .load()
    )


def text_lines(spark: SparkSession, path: str, *, streaming: bool = False) -> DataFrame:
    """Lines of text files as `value`."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("text").load(path)


def table_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A stored table, one file or a folder of files, as a stream.

    Files are taken in order of modification time. The path goes in as a glob because a plain
    path must be a folder.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    path = path.rstrip("/")
    return reader.format(fmt).load(f"{path[:-1]}[{path[-1]}]")
