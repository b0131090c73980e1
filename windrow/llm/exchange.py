"""Blocks of rows, and questions that blocks put to buckets of a key space.

Rows are packed once into blocks of bounded size, a compressed Arrow batch each, in a table in the
shared folder; packing does not shuffle. A block sends every bucket the sorted distinct keys it holds
there, as one row; a bucket sees the keys of all blocks and answers each in one row. A very frequent
key comes at most once from a block, so no bucket is hot. The number of buckets follows the size
of the data, so that neither blocks nor buckets grow with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.session import scratch_path

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20  # of text whose keys go to one bucket

_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_ZSTD) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_bytes(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


def pack(rows: DataFrame, label: str, change: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, limit: int = BLOCK_BYTES) -> DataFrame:
    """Blocks (`block`, `size` in bytes before compression, `payload`) of all rows of a table."""
    spark = rows.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def closed() -> pa.RecordBatch:
            one = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([size], pa.int64()), pa.array([to_bytes(one)], pa.binary())],
                ["block", "size", "payload"],
            )

        for batch in batches:
            start = 0
            step = max(1, int(batch.num_rows * limit / 8 / max(batch.nbytes, 1)))
            while start < batch.num_rows:
                part = batch.slice(start, step)
                start += step
                part = change(part) if change else part
                held.append(part)
                size += part.nbytes
                if size >= limit:
                    yield closed()
                    held, size = [], 0
                    block += 1
        if held:
            yield closed()

    path = scratch_path(spark, label)
    rows.mapInArrow(run, "block long, size long, payload binary").write.parquet(path)
    return spark.read.parquet(path)


def bucket_count(blocks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    return int(blocks.agg(F.sum("size")).first()[0] or 0) // bucket_bytes + 1


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted without repeats."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def _width(n: int) -> int:
    return (1 << 64) // n + 1 if n > 1 else (1 << 64) - 1


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return keys // np.uint64(_width(n))


def in_bucket(keys: np.ndarray, n: int) -> np.ndarray:
    """32-bit keys inside a bucket, in the order of the whole keys.

    A few keys of a bucket may agree in them; who asks must be able to bear with strangers.
    """
    width = _width(n)
    return np.minimum(keys % np.uint64(width) // np.uint64(max(width >> 32, 1)), np.uint64(0xFFFFFFFF)).astype(np.uint32)


def keys_by_bucket(keys: np.ndarray, n: int) -> Iterator[tuple[int, slice, np.ndarray]]:
    """Bucket, the stretch of `keys` (sorted) in it, and their distinct sorted 32-bit keys."""
    cuts = np.searchsorted(bucket_of(keys, n), np.arange(n + 1).astype(np.uint64))
    small = in_bucket(keys, n)
    for b in range(n):
        if cuts[b] < cuts[b + 1]:
            part = small[cuts[b] : cuts[b + 1]]
            yield b, slice(cuts[b], cuts[b + 1]), part[np.r_[True, part[1:] != part[:-1]]]


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct 32-bit keys as compressed differences, the bytes of one weight side by side."""
    steps = np.diff(keys, prepend=np.uint32(0)).astype("<u4")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(keys).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked_keys(body: bytes) -> np.ndarray:
    n = int.from_bytes(body[:4], "little")
    planes = pa.decompress(body[4:], decompressed_size=4 * n, codec="zstd", asbytes=True)
    steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


def ask(blocks: DataFrame, question: Callable[[dict], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """`bucket`, `block`, `body`: what `question` yields for each block row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                found = list(question(row))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([b for b, _ in found], pa.int32()),
                            pa.array([row["block"]] * len(found), pa.int64()),
                            pa.array([x for _, x in found], pa.binary()),
                        ],
                        ["bucket", "block", "body"],
                    )

    return blocks.mapInArrow(run, "bucket int, block long, body binary")


def answers(questions: DataFrame, answer: Callable[[list[dict]], list[bytes | None]], label: str) -> DataFrame:
    """`block`, `replies` (of bucket and body): all that the buckets answer a block."""
    from windrow.llm.arrow import map_groups

    def body(group: list[dict]) -> Iterator[pa.RecordBatch]:
        for row, reply in zip(group, answer(group)):
            if reply is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]], pa.int64()), pa.array([row["bucket"]], pa.int32()), pa.array([reply], pa.binary())],
                    ["block", "bucket", "body"],
                )

    spark = questions.sparkSession
    path = scratch_path(spark, label)
    map_groups(questions, "bucket", body, "block long, bucket int, body binary").write.parquet(path)
    return spark.read.parquet(path).groupBy("block").agg(F.collect_list(F.struct("bucket", "body")).alias("replies"))


def shared_keys(group: list[dict]) -> list[bytes]:
    """For every block's sorted distinct 32-bit keys, a bit each: does another block have it too?"""
    lists = [unpacked_keys(row["body"]) for row in group]
    every = np.sort(np.concatenate(lists))
    twice = distinct(every[1:][every[1:] == every[:-1]])
    if not len(twice):
        return [np.packbits(np.zeros(len(x), bool)).tobytes() for x in lists]
    return [np.packbits(twice[np.minimum(np.searchsorted(twice, x), len(twice) - 1)] == x).tobytes() for x in lists]


def reply_of(row: dict) -> dict[int, bytes]:
    return {r["bucket"]: r["body"] for r in row["replies"] or []}
