"""Small helpers for functions that work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def let_workers_import(spark: SparkSession) -> None:
    """Local workers find this package wherever the session was started from."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of every text; a null text is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut a batch so that no piece holds much more than `limit` bytes of text, or one row."""
    texts = text_bytes(batch.column(text))
    start = size = 0
    for i, value in enumerate(texts):
        if i > start and size + len(value) > limit:
            yield batch.slice(start, i - start), texts[start:i]
            start, size = i, 0
        size += len(value)
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def map_groups(rows: DataFrame, key: str, body, schema: str) -> DataFrame:
    """`body` of every group of rows with equal `key` (a list of dicts), which yields record batches.

    The rows of a group must fit a task; callers bound them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if group and group[0][key] != row[key]:
                    yield from body(group)
                    group = []
                group.append(row)
        if group:
            yield from body(group)

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)
