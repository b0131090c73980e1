"""SimHash near-duplicates by a grid join on per-segment bit counts.

Fingerprints are embedded as the bit counts of 32 two-bit segments; the Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints. The grid is laid over bands of
the embedding: with `b` bands and at most `d` differing bits, at least b - d bands are
equal, so linked fingerprints meet in a cell of some choice of b - d bands. Within a cell a
pair must pass the Manhattan bound and then the exact bit comparison. Nothing is left out.

That holds for any b > d. More bands mean more choices, but cells of more bits: the number of bands follows from the
number of fingerprints and the measured spread of each segment, so that cells do not fill up as the data grow.

Equal fingerprints are one node. A cell with more than `TILE` nodes is cut into tiles, and each
pair of tiles is a group of its own, so that no task holds more than two tiles of one cell at a time. A
group hands on a spanning forest of its links, never all pairs; components come from repeated
star contraction of those links.

Texts: A-Z are lower-cased, words are runs of bytes other than U+0020 and U+0009 to U+000D, a
shingle is `size` words (all words, if fewer). A text without words (null, empty) has fingerprint 0,
linked like any other. Repeated rows and ids give a row each. The component of a node is the
smallest id in it; null ids are never the smallest, and a component of null ids only has a null id. An
empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm.arrow import chunks
from windrow.session import scratch_path

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
TILE = 2048
MOST_BANDS = 12  # 495 choices with 4 differing bits
PAIR_COST = 0.02  # assumed, not measured: of comparing two fingerprints of a cell, against storing and moving a row of a cell
_ODD = np.uint64(0x5555555555555555)


def fingerprints_of(texts: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """64-bit SimHashes: a bit is set if it is set in over half of the shingles' XXH64."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        if len(words) > size:
            found = [digest(b" ".join(w), SEED) for w in zip(*(words[k:] for k in range(size)))]
        else:
            found = [digest(b" ".join(words), SEED)] if words else []
        hashes += found
        counts[i] = len(found)
    owner = np.repeat(np.arange(len(texts)), counts) * 256
    octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    bits = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.float64)
    out = np.zeros(len(texts), np.uint64)
    for k in range(8):
        histogram = np.bincount(owner + octets[:, k], minlength=256 * len(texts)).reshape(-1, 256)
        ones = histogram @ bits
        byte = ((2 * ones > counts[:, None]) << np.arange(8)).sum(axis=1).astype(np.uint64)
        out |= byte << np.uint64(8 * k)
    return out


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, also: tuple[str, ...] = ()
) -> DataFrame:
    """`key`, the columns `also`, and `fp`, the fingerprint as a signed 64-bit number."""
    names = [key, *also]
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names) + ", fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, text, 1 << 19):
                found = pa.array(fingerprints_of(texts, size).view(np.int64))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), found], [*names, "fp"])

    return docs.select(*names, text).mapInArrow(run, schema)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def embedding(fps: np.ndarray) -> np.ndarray:
    """Bit counts (0 to 2) of the 32 two-bit segments, in two bits each."""
    return (fps & _ODD) + (fps >> np.uint64(1) & _ODD)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of embeddings in whose two-bit fields 3 does not occur.

    As unary codes (0 = 00, 1 = 01, 2 = 11) the distance of two fields is the count of differing bits.
    """
    a, b = ((x | (x >> np.uint64(1) & _ODD)) for x in (a, b))
    return _popcount(a ^ b)


def _choices(max_bits: int, bands: int) -> Iterator[list[int]]:
    """The segments of every choice of bands that must agree."""
    edges = [round(k * 32 / bands) for k in range(bands + 1)]
    runs = [range(a, b) for a, b in zip(edges, edges[1:])]
    for chosen in itertools.combinations(runs, bands - max_bits):
        yield [s for run in chosen for s in run]


@functools.cache
def _masks(max_bits: int, bands: int) -> list[tuple[int, np.uint64]]:
    """A mask of the embedding for every choice."""
    return [(i, np.uint64(sum(3 << 2 * s for s in c))) for i, c in enumerate(_choices(max_bits, bands))]


def segment_counts(nodes: DataFrame) -> np.ndarray:
    """How many fingerprints have 0, 1 and 2 bits in each of the 32 segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = embedding(batch.column("fp").to_numpy().view(np.uint64))
            found = [np.bincount((where >> np.uint64(2 * s) & np.uint64(3)).astype(np.int64), minlength=3) for s in range(32)]
            found = np.array(found, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(32, dtype=np.int32)), *map(pa.array, found.T.copy())], ["segment", "n0", "n1", "n2"])

    counted = nodes.select("fp").mapInArrow(run, "segment int, n0 long, n1 long, n2 long").groupBy("segment")
    out = np.zeros((32, 3), np.int64)
    for row in counted.agg(F.sum("n0"), F.sum("n1"), F.sum("n2")).collect():  # 32 rows
        out[row[0]] = row[1:]
    return out


def choose_bands(counts: np.ndarray, max_bits: int = MAX_BITS) -> int:
    """The number of bands with the least expected work for fingerprints of these segment counts.

    A fingerprint has one row for each choice of bands, and meets those that agree in all segments of the choice: their share
    is the product, over the segments, of the chance that two fingerprints agree there.
    """
    n = max(int(counts[0].sum()), 1)
    equal = ((counts / n) ** 2).sum(axis=1)

    def work(bands: int) -> float:
        return sum(1 + PAIR_COST * n / 2 * float(np.prod(equal[c])) for c in _choices(max_bits, bands))

    return min(range(min(max_bits + 2, 32), min(max(max_bits + 2, MOST_BANDS), 32) + 1), key=work)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _cells(nodes: DataFrame, max_bits: int, bands: int) -> DataFrame:
    """`grid` (which bands), `cell` (their bit counts) and `fp`, for every node and grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            where = embedding(fps)
            for grid, mask in _masks(max_bits, bands):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(fps), grid, np.int32)),
                        pa.array((where & mask).view(np.int64)),
                        pa.array(fps.view(np.int64)),
                    ],
                    ["grid", "cell", "fp"],
                )

    return nodes.select("fp").mapInArrow(run, "grid int, cell long, fp long")


def _forest(fps: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links between places in `fps`, an edge from each linked one to the smallest it reaches."""
    values, place = np.unique(fps, return_inverse=True)
    a, b = place[left], place[right]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(values)))
    return values[moved], values[root[moved]]


def _linked(fps: np.ndarray, group: np.ndarray, side: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal `group`; sides 1 and 2 are linked with each other only, side 0 within."""
    n = len(fps)
    where = embedding(fps)
    end = np.r_[np.flatnonzero(group[1:] != group[:-1]) + 1, n]
    left = np.repeat(end, np.diff(np.r_[0, end])) - np.arange(n) - 1  # partners behind each row
    found_a, found_b = [], []
    alive = np.flatnonzero(left > 0)
    step = 1
    while len(alive):
        other = alive + step
        ok = (side[alive] == 0) | (side[alive] != side[other])
        ok &= manhattan(where[alive], where[other]) <= max_bits
        i, j = alive[ok], other[ok]
        close = _popcount(fps[i] ^ fps[j]) <= max_bits
        if close.any():
            found_a.append(i[close])
            found_b.append(j[close])
        if sum(map(len, found_a)) > 1 << 20:  # many links: only what they connect is needed
            a, b = _forest(fps, np.concatenate(found_a), np.concatenate(found_b))
            values, at = np.unique(fps, return_index=True)
            found_a, found_b = [at[np.searchsorted(values, a)]], [at[np.searchsorted(values, b)]]
        step += 1
        alive = alive[left[alive] >= step]
    if not found_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return _forest(fps, np.concatenate(found_a), np.concatenate(found_b))


def links(nodes: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE, bands: int | None = None) -> DataFrame:
    """Edges `a`, `b` (fingerprints, a != b) that connect exactly what links of `nodes` connect.

    `nodes` is a stored table with distinct fingerprints in `fp`. `bands` changes the work, not what is connected; unless
    given, it follows from the fingerprints.
    """
    spark = nodes.sparkSession
    if bands is None:
        bands = choose_bands(segment_counts(nodes), max_bits)
    if not max_bits < bands <= 32:
        raise ValueError(f"bands must be more than {max_bits} and at most 32, not {bands}")
    path = scratch_path(spark, "cells")
    _cells(nodes, max_bits, bands).write.parquet(path)
    cells = spark.read.parquet(path)
    full = cells.groupBy("grid", "cell").count().filter(F.col("count") > tile)
    full = full.select(F.col("grid").alias("full_grid"), F.col("cell").alias("full_cell"), F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    joined = cells.join(full, (F.col("grid") == F.col("full_grid")) & (F.col("cell") == F.col("full_cell")), "left")
    own = F.pmod(F.xxhash64("fp"), F.coalesce("tiles", F.lit(1))).cast("int")
    # a tile meets itself and, as side 1 or 2, every other tile of its cell
    pairs = F.transform(
        F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1),
        lambda t: F.struct(
            F.least(t, F.col("own")).alias("low"),
            F.greatest(t, F.col("own")).alias("high"),
            F.when(t == F.col("own"), 0).when(t > F.col("own"), 1).otherwise(2).alias("side"),
        ),
    )
    tiled = joined.withColumn("own", own).select("grid", "cell", "fp", F.explode(pairs).alias("t"))
    group = F.xxhash64("grid", "cell", "t.low", "t.high")
    rows = tiled.select(group.alias("group"), F.col("t.side").alias("side"), "fp")
    rows = rows.repartition("group").sortWithinPartitions("group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = [batch.column(c).to_numpy() for c in ("group", "side", "fp")]
                kept = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
            if kept is None or not len(kept[0]):
                continue
            # the last group may go on in the next batch
            cut = len(kept[0]) if batch is None else int(np.searchsorted(kept[0], kept[0][-1]))
            if not cut:
                continue
            a, b = _linked(kept[2][:cut].view(np.uint64), kept[0][:cut], kept[1][:cut], max_bits)
            kept = [x[cut:] for x in kept]
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """`node` and `label` (the smallest node reachable) of every node that has an edge.

    Every round hangs the larger neighbours of each node, then its smaller ones, on the smallest
    neighbour; it ends when the edges form stars. Rounds are tables in the shared folder.
    """
    spark = edges.sparkSession

    def stored(table: DataFrame) -> DataFrame:
        path = scratch_path(spark, "edges")
        table.write.parquet(path)
        return spark.read.parquet(path)

    def starred(table: DataFrame, both: bool) -> DataFrame:
        arcs = table.select("a", "b")
        if both:
            arcs = arcs.union(table.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(arcs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")))
        hung = arcs.join(least.select(F.col("a").alias("center"), "low"), F.col("a") == F.col("center"))
        if both:
            moved = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            moved = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).union(least.select("a", F.col("low").alias("b")))
        return stored(moved.filter("a != b").distinct())

    size = F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    ordered = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    before = None
    while True:
        now = ordered.agg(F.count(F.lit(1)), size).first()
        if now == before or not now[0]:
            return ordered.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = now
        ordered = starred(starred(ordered, True), False)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """`key`, `fp`, `component_fp` (smallest fingerprint reached) and `component_id` (smallest id)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    fingerprints(docs, key, text, size).write.parquet(path)
    return _grouped(spark.read.parquet(path), key, max_bits)


def _grouped(rows: DataFrame, key: str, max_bits: int) -> DataFrame:
    """Add `component_fp` and `component_id` to stored rows with a fingerprint."""
    spark = rows.sparkSession
    path = scratch_path(spark, "nodes")
    rows.groupBy("fp").agg(F.min(key).alias("first")).write.parquet(path)
    nodes = spark.read.parquet(path)
    labels = components(links(nodes, max_bits))
    nodes = nodes.join(labels, F.col("fp") == F.col("node"), "left")
    nodes = nodes.select("fp", "first", F.coalesce("label", "fp").alias("component_fp"))
    least = nodes.groupBy("component_fp").agg(F.min("first").alias("component_id"))
    path = scratch_path(spark, "components")
    nodes.join(least, "component_fp").select(F.col("fp").alias("node"), "component_fp", "component_id").write.parquet(path)
    known = spark.read.parquet(path)
    return rows.join(known, F.col("fp") == F.col("node")).drop("node")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: that with the smallest id.

    Where several texts of a component share this id, that of the smallest fingerprint stays (then that of the smallest
    SHA-256). An id that stands for texts of different components keeps one in each. Equal rows of a document that stays are
    one. Rows without an id have no place in the order and all stay.
    """
    spark = docs.sparkSession
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    path = scratch_path(spark, "fingerprints")
    named = docs.filter(F.col(key).isNotNull())
    fingerprints(named.select(key, text, digest.alias("_simhash_text")), key, text, size, also=("_simhash_text",)).write.parquet(path)
    rows = _grouped(spark.read.parquet(path), key, max_bits).filter(F.col(key) == F.col("component_id"))
    first = rows.groupBy("component_fp", "component_id").agg(F.min(F.struct("fp", "_simhash_text"))["_simhash_text"].alias("_simhash_first"))
    first = first.select(F.col("component_id").alias("_simhash_id"), "_simhash_first")
    # equal rows are combined before they are moved, and meet the chosen ones where they come to lie
    single = named.withColumn("_simhash_text", digest).dropDuplicates([key, "_simhash_text"])
    chosen = (F.col(key) == F.col("_simhash_id")) & (F.col("_simhash_text") == F.col("_simhash_first"))
    kept = single.join(first, chosen, "left_semi").drop("_simhash_text")
    return kept.unionByName(docs.filter(F.col(key).isNull()))
