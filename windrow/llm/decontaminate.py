"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts are normalised to words: A-Z lower-cased, runs of everything but the ASCII characters that
are neither letters nor digits. The automaton of all items is built over words. A document's words
are streamed through it, which tracks the longest match that ends at each word. Where it reaches
`window` words, the last `window` words are hit; an item shorter than that counts where the whole of
it matches. Documents are not shuffled.

Items are taken in shards of at most `shard_words` words (one longer item is a shard of its own), so that what is built on the
driver and sent to the executors is bounded: 2^18 words take some 140 MB. With more than one shard the documents are read once
for each, one shard after the other, and the hits of a shard are stored before the next is built. Repeated items each count
under their own id; an item without words matches nothing; one with a null id makes words hit but
is not listed. Null and empty documents have no words. Every document row is judged by itself, so
repeated rows stay; with several shards, findings are joined by a hash of the text. Only the
columns named are read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.arrow import chunks
from windrow.llm.columns import running_maxima
from windrow.llm.quality import let
from windrow.operators.small_side import broadcast_if_small
from windrow.session import scratch_path

WINDOW = 10
SHARD_WORDS = 1 << 18
MAX_COVERAGE = 0.5
DIGEST, HITS = "_decontaminate_digest", "_decontaminate_hits"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Automaton:
    """Suffix automaton of several word sequences; words are numbers from 1."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.words: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.words.setdefault(w, len(self.words) + 1) for w in words]) for name, words in items]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        #: items of a state, for a string of exactly this many words
        self.found: dict[tuple[int, int], set[str]] = {}
        self.shortest = min((min(len(w), window) for _, w in coded if w), default=0)
        for name, words in coded:
            if words:
                self._mark(name, words, min(len(words), window))

    def _extend(self, last: int, w: int) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:
            q = step[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, q, w)
        new = self._state(length[last] + 1, {})
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = step[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, q, w)
        return new

    def _state(self, length: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(-1)
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.step[q]))
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = clone
            p = self.link[p]
        return clone

    def _cut(self, state: int, size: int) -> int:
        """The state of the last `size` words of a match in `state`."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _mark(self, name: str | None, words: list[int], size: int) -> None:
        state = matched = 0
        for w in words:
            state = self.step[state][w]
            matched += 1
            if matched >= size:
                state = self._cut(state, size)
                matched = size
                self.found.setdefault((state, size), set()).update([] if name is None else [name])

    def search(self, words: list[bytes], window: int) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items whose windows occur."""
        hit = np.zeros(len(words) + 1, np.int64)
        names: set[str] = set()
        get = self.words.get
        codes = [get(w, 0) for w in words]
        known = np.array(codes, np.int64) > 0
        edges = np.flatnonzero(np.diff(np.r_[False, known, False]))
        step, link, length, found = self.step, self.link, self.length, self.found
        sizes = sorted({size for _, size in found}, reverse=True)
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a < self.shortest:
                continue
            state = matched = 0
            for i in range(a, b):
                w = codes[i]
                while state and w not in step[state]:
                    state = link[state]
                    matched = length[state]
                if w in step[state]:
                    state = step[state][w]
                    matched += 1
                if matched < self.shortest:
                    continue
                cut = state
                for size in sizes:
                    if size <= matched:
                        cut = self._cut(cut, size)
                        if (cut, size) in found:
                            names |= found[cut, size]
                            hit[i + 1 - size] += 1
                            hit[i + 1] -= 1
        return np.cumsum(hit)[:-1] > 0, names


def normal_words(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


def _shards(benchmark: DataFrame, item: str, text: str, shard_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items in lots of bounded size, fetched one partition at a time."""
    lot, size = [], 0
    for row in benchmark.select(item, text).toLocalIterator():
        words = normal_words((row[1] or "").encode())
        if lot and size + len(words) > shard_words:
            yield lot
            lot, size = [], 0
        lot.append((None if row[0] is None else str(row[0]), words))
        size += len(words)
    yield lot


def _scan(docs: DataFrame, shared: Broadcast, key: str, text: str, window: int) -> DataFrame:
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            for part, texts in chunks(batch, text):
                rows = []
                for raw in texts:
                    words = normal_words(raw)
                    hit, names = found.search(words, window)
                    edges = np.flatnonzero(np.diff(np.r_[False, hit, False])).tolist()
                    rows.append((len(words), list(zip(edges[::2], edges[1::2])), sorted(names)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key),
                        pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in texts], pa.binary()),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([[{"start": a, "stop": b} for a, b in r[1]] for r in rows], SPANS),
                        pa.array([r[2] for r in rows], pa.list_(pa.string())),
                    ],
                    [key, "digest", "n_words", "spans", "items"],
                )

    schema = f"`{key}` {kind}, digest binary, n_words long, spans array<struct<start:int,stop:int>>, items array<string>"
    return docs.select(key, text).mapInArrow(run, schema)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _merged(spans: Column) -> Column:
    """Sorted spans without overlaps."""

    def joined(s: Column, reach: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["start"] > F.get(reach, i - 1)))

        def run(firsts: Column, i: Column, k: Column) -> Column:
            last = F.coalesce(F.get(firsts, k + 1), F.size(s)) - 1
            return F.struct(F.get(s, i)["start"].alias("start"), F.get(reach, last).cast("int").alias("stop"))

        return let(first, lambda f: F.transform(f, lambda i, k: run(f, i, k)))

    empty = F.array().cast("array<struct<start:int,stop:int>>")
    ends = lambda s: running_maxima(F.transform(s, lambda x: x["stop"]))
    return let(spans, lambda s: F.when(F.size(s) > 0, let(ends(s), lambda r: joined(s, r))).otherwise(empty))


def _stored_hits(docs: DataFrame, lots: Iterator[list], key: str, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """`key`, `digest`, `n_words` of every row; `digest`, `spans` and `items` of the texts with hits, over all shards.

    One shard at a time: its automaton is built, sent out, and given up when its hits are stored.
    """
    spark = docs.sparkSession
    tables = []
    for lot in lots:
        shared = spark.sparkContext.broadcast(Automaton(lot, window))
        found = _scan(docs, shared, key, text, window)
        path = scratch_path(spark, "hits")
        (found if not tables else found.filter(F.size("spans") > 0)).write.parquet(path)
        shared.destroy()
        tables.append(spark.read.schema(found.schema).parquet(path))
    hits = [t.filter(F.size("spans") > 0).select("digest", "spans", "items") for t in tables]
    # findings go by the text alone, so equal texts are combined before rows are moved
    merged = functools.reduce(DataFrame.unionByName, hits).groupBy("digest").agg(
        _merged(F.array_sort(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return tables[0].select(key, "digest", "n_words"), merged


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """A row for each document: `key`, `n_words`, `n_hit`, `spans` of words hit, `items` found."""
    lots = _shards(benchmark, item, item_text, shard_words)
    first, second = next(lots), next(lots, None)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("n_hit")
    if second is None:
        shared = docs.sparkSession.sparkContext.broadcast(Automaton(first, window))
        return _scan(docs, shared, key, text, window).select(key, "n_words", n_hit, "spans", "items")
    rows, merged = _stored_hits(docs, itertools.chain((first, second), lots), key, text, window)
    joined = rows.join(merged, "digest", "left").select(
        key,
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return joined.select(key, "n_words", n_hit, "spans", "items")


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    n_chars: str = "n_chars",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """`docs` without the spans that are hit, each cut from its first to its last word.

    Documents of which more than `max_coverage` of the words are hit go altogether. Texts without a
    hit stay as they are. The hits of all shards are gathered before anything is cut. `n_chars`, if there is such a column, follows the text.
    """
    lots = _shards(benchmark, item, item_text, shard_words)
    first, second = next(lots), next(lots, None)
    if second is None:
        shared = docs.sparkSession.sparkContext.broadcast(Automaton(first, window))

        def search(texts: list[bytes], part: pa.RecordBatch) -> Iterator[np.ndarray | None]:
            return (shared.value.search(normal_words(raw), window)[0] for raw in texts)

        return _cut(docs, docs, search, text, n_chars, max_coverage)

    # all shards judge the text as it came in; equal texts have equal findings
    hashed = docs.select(F.sha2(docs[text].cast("binary"), 256).alias(DIGEST), docs[text].alias(text))
    named, merged = _stored_hits(hashed, itertools.chain((first, second), lots), DIGEST, text, window)
    # as text, whose size is counted before it is broadcast
    found = named.select(DIGEST, "digest").distinct().join(merged, "digest")
    spans = broadcast_if_small(found.select(DIGEST, F.to_json("spans").alias(HITS)))
    rows = docs.withColumn(DIGEST, F.sha2(docs[text].cast("binary"), 256)).join(spans, DIGEST, "left").drop(DIGEST)

    def known(texts: list[bytes], part: pa.RecordBatch) -> Iterator[np.ndarray | None]:
        for raw, spans in zip(texts, part.column(HITS).to_pylist()):
            hit = np.zeros(len(normal_words(raw)), bool) if spans else None
            for span in json.loads(spans or "[]"):
                hit[span["start"] : span["stop"]] = True
            yield hit

    return _cut(docs, rows, known, text, n_chars, max_coverage)


def _cut(docs: DataFrame, rows: DataFrame, hits, text: str, n_chars: str, max_coverage: float) -> DataFrame:
    """`rows`, which begin with the columns of `docs`, without the words that `hits` of their texts names."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes = batch.schema.get_field_index(text), batch.schema.get_field_index(n_chars)
            for part, texts in chunks(batch, text):
                keep = np.ones(len(texts), bool)
                new: list[bytes | None] = part.column(at).cast(pa.binary()).to_pylist()
                changed = False
                for i, (raw, hit) in enumerate(zip(texts, hits(texts, part))):
                    if hit is None or not hit.any():
                        continue
                    places = [m.span() for m in WORD.finditer(raw.lower())]  # of the same length
                    keep[i] = hit.mean() <= max_coverage
                    edges = np.flatnonzero(np.diff(np.r_[False, hit, False])).tolist()
                    pieces, last = [], 0
                    for a, b in zip(edges[::2], edges[1::2]):
                        pieces.append(raw[last : places[a][0]])
                        last = places[b - 1][1]
                    new[i] = b"".join([*pieces, raw[last:]])
                    changed = True
                if changed:
                    column = pa.array([None if x is None else x.decode() for x in new], part.column(at).type)
                    part = part.set_column(at, part.schema.field(at), column)
                    if sizes >= 0:
                        counts = pa.array([None if x is None else len(x) for x in column.to_pylist()], pa.int64())
                        kept = part.column(sizes)
                        part = part.set_column(sizes, part.schema.field(sizes), _replaced(kept, counts, texts, new))
                yield part.select(names).filter(pa.array(keep))

    return rows.mapInArrow(run, docs.schema)


def _replaced(old: pa.Array, counts: pa.Array, before: list[bytes], after: list[bytes | None]) -> pa.Array:
    """`counts` where the text has changed, else what was there."""
    return pa.array(
        [n if b is not None and b != a else o for o, n, a, b in zip(old.to_pylist(), counts.to_pylist(), before, after)], old.type
    )
