"""Token ids in files of directly addressable codes.

An id is cut into chunks of 8 bits, the lowest in level 0. Every level stores its chunks side by side, and a
bitmap of which of them go on in the next level with a directory of the set bits before each 512.
The place of a token's next chunk is the rank of its bit, so any token is read with a few look-ups
and no block is decoded.

A file (Parquet, written by Spark's committers to any store) holds segments in ascending order of
the key: `segment` (number in that order), `first`, `n_tokens`, `payload`. A payload is whole in
itself: keys and sizes of its documents, then the levels.

Texts: null is empty; an empty text has the end id only. Null keys come first. Repeated rows stay, in any
order among themselves. Only the columns named are read; an empty table gives no segments.
"""

from __future__ import annotations

import functools
import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from windrow.llm.arrow import chunks

MAGIC = b"DAC1"
CHUNK_BITS = 8
DIRECTORY_BITS = 512
SEGMENT_TOKENS = 1 << 21
END_ID = 1
CACHE_BYTES = 128 << 20
WORD_BYTES = 180  # of a known word besides its bytes and ids
LOT_WORDS = 512
LOT_BYTES = 4 << 20  # of texts encoded at a time
_END = array("I", [END_ID]).tobytes()


def _level(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    more = values >> CHUNK_BITS > 0
    bits = np.packbits(more, bitorder="little")
    padded = np.zeros(-(-max(len(values), 1) // DIRECTORY_BITS) * DIRECTORY_BITS // 8, np.uint8)
    padded[: len(bits)] = bits
    counts = np.bitwise_count(padded).reshape(-1, DIRECTORY_BITS // 8).sum(axis=1)
    directory = (np.cumsum(counts) - counts).astype("<u4")
    chunk = (values & 0xFF).astype(np.uint8)
    return struct.pack("<I", len(values)) + directory.tobytes() + padded.tobytes() + chunk.tobytes(), values[more] >> CHUNK_BITS


def pack(keys: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """A segment of documents with these keys and token counts."""
    levels = []
    rest = ids.astype(np.uint64)
    while len(rest) or not levels:
        level, rest = _level(rest)
        levels.append(level)
    head = struct.pack("<4sII", MAGIC, len(keys), len(levels))
    known = np.array([k is not None for k in keys], np.uint8)
    numbers = np.array([k or 0 for k in keys], "<i8")
    return b"".join([head, known.tobytes(), numbers.tobytes(), np.array(sizes, "<u8").tobytes(), *levels])


class Segment:
    """Reads a payload."""

    def __init__(self, payload: bytes):
        magic, n, n_levels = struct.unpack_from("<4sII", payload)
        if magic != MAGIC:
            raise ValueError("not a segment of token codes")
        at = 12
        known = np.frombuffer(payload, np.uint8, n, at)
        numbers = np.frombuffer(payload, "<i8", n, at + n)
        self.keys = [int(k) if ok else None for k, ok in zip(numbers, known)]
        self.sizes = np.frombuffer(payload, "<u8", n, at + 9 * n).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        at += 17 * n
        self.levels = []
        for _ in range(n_levels):
            (size,) = struct.unpack_from("<I", payload, at)
            lots = -(-max(size, 1) // DIRECTORY_BITS)
            directory = np.frombuffer(payload, "<u4", lots, at + 4)
            bits = np.frombuffer(payload, np.uint8, lots * DIRECTORY_BITS // 8, at + 4 + 4 * lots)
            chunk = np.frombuffer(payload, np.uint8, size, at + 4 + 4 * lots + len(bits))
            self.levels.append((size, directory, bits, chunk))
            at += 4 + 4 * lots + len(bits) + size

    def token(self, document: int, i: int) -> int:
        """Token `i` of the document at place `document`, without decoding any other."""
        place, value = int(self.starts[document]) + i, 0
        for shift, (_, directory, bits, chunk) in enumerate(self.levels):
            value |= int(chunk[place]) << CHUNK_BITS * shift
            if not bits[place >> 3] >> (place & 7) & 1:
                break
            lot, byte = place // DIRECTORY_BITS, place >> 3
            before = int(np.bitwise_count(bits[lot * DIRECTORY_BITS // 8 : byte]).sum())
            before += int(bits[byte] & ((1 << (place & 7)) - 1)).bit_count()
            place = int(directory[lot]) + before
        return value

    def ids(self) -> np.ndarray:
        """All ids of the segment."""
        value = np.empty(0, np.uint64)
        for size, _, bits, chunk in reversed(self.levels):
            more = np.unpackbits(bits, count=size, bitorder="little").astype(bool)
            upper = np.zeros(size, np.uint64)
            upper[more] = value
            value = upper << np.uint64(CHUNK_BITS) | chunk
        return value


class Encoder:
    """Ids of whole texts by way of their words, for tokenizers that never join or look across white space.

    A text is cut at ASCII white space, as no normal form and no pattern of such a tokenizer reaches over it, and
    the library encodes each word that is not known yet, `LOT_WORDS` at a time. Once the known words hold `CACHE_BYTES`
    they become the old ones, and of the old ones those not met again are forgotten. Special tokens in a text are one
    id, unless `encode_special_tokens` spells them out; they hold no white space and take none away.
    """

    def __init__(self, path: str, encode_special_tokens: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = encode_special_tokens
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def _library(self, words: list[bytes]) -> list[bytes]:
        """The ids of every word, from one text of all: those between the end of the word before and its own."""
        texts = [w.decode() for w in words]
        (found,) = self.tokenizer.encode_batch([" ".join(texts)], add_special_tokens=False)
        ids = array("I", found.ids).tobytes()
        stops = np.fromiter((stop for _, stop in found.offsets), np.int64, len(ids) // 4)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        cuts = (4 * np.searchsorted(stops, ends, "right")).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts], cuts)]

    def _ids(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of distinct words; the empty word has none."""
        if self.held > CACHE_BYTES:
            self.old, self.known, self.held = self.known, {}, 0
        found = [*map(self.known.get, words)]
        wanted = [i for i, ids in enumerate(found) if ids is None and words[i]]
        for i, ids in zip(wanted, [*map(self.old.get, map(words.__getitem__, wanted))]):
            found[i] = ids
        new = [i for i in wanted if found[i] is None]
        for k in range(0, len(new), LOT_WORDS):
            lot = new[k : k + LOT_WORDS]
            for i, ids in zip(lot, self._library([words[i] for i in lot])):
                found[i] = ids
        self.known.update((words[i], found[i]) for i in wanted)
        self.held += sum(len(words[i]) + len(found[i]) + WORD_BYTES for i in wanted)
        return found

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of every text, with the end id."""
        # an empty word stands before white space at the start and after some at the end
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        ends = cut.offsets.to_numpy()[1:]
        coded = cut.values.dictionary_encode()
        words = coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        ids = pa.array([*self._ids(words), _END], pa.binary())
        _, offsets, values = ids.buffers()
        offsets = np.frombuffer(offsets, np.int32, len(ids) + 1) // 4
        table = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(values, np.uint32, offsets[-1])))
        found = table.take(pa.array(np.insert(coded.indices.to_numpy(), ends, len(words))))
        stops = found.offsets.to_numpy()[ends + np.arange(1, len(ends) + 1)]
        return np.split(found.values.to_numpy(), stops[:-1])


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path, encode_special_tokens=False)  # the tokenizer as its file has it


def write(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", segment_tokens: int = SEGMENT_TOKENS
) -> None:
    """Encode all texts, each closed by the end id, into files below `path`."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        part = TaskContext.get().partitionId() << 32
        keys, sizes, ids, held, number = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            columns = [pa.array([part + number], pa.int64()), pa.array([keys[0]], pa.int64()), pa.array([len(flat)], pa.int64())]
            return pa.RecordBatch.from_arrays([*columns, pa.array([pack(keys, sizes, flat)], pa.binary())], ["segment", "first", "n_tokens", "payload"])

        for batch in batches:
            for piece, texts in chunks(batch, "text", LOT_BYTES):
                for k, new in zip(piece.column("key").to_pylist(), encoder.encode(texts)):
                    keys.append(k)
                    sizes.append(len(new))
                    ids.append(new)
                    held += len(new)
                    if held >= segment_tokens:
                        yield closed()
                        keys, sizes, ids, held = [], [], [], 0
                        number += 1
        if keys:
            yield closed()

    rows.mapInArrow(run, "segment long, first long, n_tokens long, payload binary").write.parquet(path)


def directory(spark: SparkSession, path: str) -> DataFrame:
    """`segment` and `segment_start`, the count of ids in all segments before it.

    Summed inside the segments that one task wrote, then over tasks: the one unpartitioned window has a
    row for each task of the write.
    """
    sizes = spark.read.parquet(path).select("segment", "n_tokens", F.shiftright("segment", 32).alias("task"))
    inside = W.partitionBy("task").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    tasks = sizes.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    tasks = tasks.select("task", F.coalesce(before, F.lit(0)).alias("task_start"))
    sizes = sizes.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(tasks, "task")
    return sizes.select("segment", (F.col("task_start") + F.col("inside")).alias("segment_start"))


def read_digests(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """`key`, `start`, `n_tokens` and `ids_crc32` of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column("segment").to_pylist(), batch.column("payload")):
                segment = Segment(payload.as_py())
                flat = segment.ids().astype("<u4")
                ends = segment.starts + segment.sizes
                sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(segment.starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(sums), pa.int64()),
                        pa.array(segment.keys, pa.int64()),
                        pa.array(segment.starts),
                        pa.array(segment.sizes),
                        pa.array(sums, pa.int64()),
                    ],
                    ["segment", key, "inside", "n_tokens", "ids_crc32"],
                )

    found = spark.read.parquet(path).select("segment", "payload")
    found = found.mapInArrow(run, f"segment long, `{key}` long, inside long, n_tokens long, ids_crc32 long")
    joined = found.join(directory(spark, path), "segment")
    return joined.select(key, (F.col("segment_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, path: str, segment: int, document: int, token: int) -> int:
    """One token by its address."""
    payload = spark.read.parquet(path).filter(F.col("segment") == segment).select("payload").first()[0]
    return Segment(payload).token(document, token)
