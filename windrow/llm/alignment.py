"""Which tokens of two tokenizers stand for the same bytes, counted over the whole corpus.

A is a byte-level BPE (file of the tokenizers library), B a byte-fallback BPE (sentencepiece model). A encodes a space and the
text; B encodes the text and adds that space itself. Where tokens of both end at the same byte, a group ends; every A and
every B token of a group are linked.

Both tokenizers part a text before a space that follows something other than white space: no token of A reaches across,
and no piece of B has a space behind another character (checked when the model is loaded). The stretches in between are
therefore encoded and aligned once for each worker (bounded store) and put together for each text. Texts with a stretch that
does not come back as it was are encoded whole, and have no tokens if the whole does not come back either.

The index is inverted: for each pair of ids and each block of up to 2^16 documents a bitmap of the documents that have the
pair linked, compressed as in roaring bitmaps (16-bit numbers up to 4096, bits beyond). Bits of the multiplicity
less one are further planes: plane k + 1 holds the documents where bit k is set. Blocks are disjoint, so the union of a
pair's bitmaps is the list of them; its population count is the sum of theirs and says how many documents hold the pair.
The link count of a pair is the sum of 2^k times the population counts of planes. Scores come back through the postings: each
gives its documents the pair's count, as often as its plane says.

Null and empty texts have no tokens. Texts are never cut. Rows are kept one by one, whatever their ids; only the two columns
named are read; an empty table gives an empty result. A block is closed at 2^16 documents or `BLOCK_LINKS` links, so memory is
bounded by that and the longest text. Blocks are numbered inside the job that writes them, and all else reads what it
committed, so a task that runs again changes nothing.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from windrow.llm.arrow import chunks
from windrow.operators.small_side import broadcast_if_small
from windrow.session import scratch_path

BLOCK_DOCS = 1 << 16
BLOCK_LINKS = 1 << 22
CACHE_UNITS = 1 << 18
LEARN_BYTES = 1 << 22
WIDE_GROUP = 1 << 12  # links of a group from which repeated ids are counted first
SPARSE = 4096  # documents up to which a bitmap is a list of 16-bit numbers
DOC_BITS = 16

# a space that does not follow a character other than white space is inside a stretch
_INNER_SPACE = re.compile(r"(?:\A|\s) ")
_CUT = re.compile(r"(?<=\S) ")
SPACE_MARK = "▁"


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself, or the next one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = sorted(set(range(256)) - set(plain))
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


@functools.cache
def _tokenizer_a(path: str):
    """The tokenizer and the bytes of its entries."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are plain text
    symbol = byte_of_symbol()
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    entries = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in symbol for c in token):
            entries[i] = bytes(symbol[c] for c in token)
    return tokenizer, entries


@functools.cache
def _tokenizer_b(path: str):
    """The processor, the bytes of its pieces, and the id of the space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", piece):
            raise ValueError(f"piece {i} has a space behind another character")
        if model.is_byte(i):
            entries.append(bytes([int(piece[3:5], 16)]))
        else:
            entries.append(piece.replace(SPACE_MARK, " ").encode())
    return model, entries, model.piece_to_id(SPACE_MARK)


@dataclass
class Aligned:
    """Stretches one after the other: sizes, links and descriptions of each."""

    right: np.ndarray  # do the tokens come back as the bytes they were made of?
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    codes: np.ndarray  # a << 32 | b of links, those of wide groups left out
    code_counts: np.ndarray  # how many codes each stretch has
    wide: dict[int, list[tuple[np.ndarray, np.ndarray]]]  # codes and multiplicities of wide groups
    groups: list[str]


class Aligner:
    def __init__(self, path_a: str, path_b: str, limit: int = CACHE_UNITS):
        self.a, entries_a = _tokenizer_a(path_a)
        self.b, entries_b, self.space = _tokenizer_b(path_b)
        self.entries_a, self.entries_b = entries_a, entries_b
        self.size_a, self.size_b = (np.array([len(x) for x in e], np.int64) for e in (entries_a, entries_b))
        self.name_a, self.name_b = ([str(i) for i in range(len(e))] for e in (entries_a, entries_b))
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.store = self.align([])

    def align(self, stretches: list[str]) -> Aligned:
        """Encode and align; a stretch is given without the space in front of it."""
        found_a = [x.ids for x in self.a.encode_batch([" " + s for s in stretches], add_special_tokens=False)] if stretches else []
        found_b = [x if s else [self.space] for s, x in zip(stretches, self.b.encode(stretches, num_threads=1))] if stretches else []
        data = [b" " + s.encode() for s in stretches]
        right = np.ones(len(stretches), bool)
        for found, entries in ((found_a, self.entries_a), (found_b, self.entries_b)):
            right &= np.array([b"".join([entries[i] for i in x]) == d for x, d in zip(found, data)], bool)
        for k in np.flatnonzero(~right).tolist():
            found_a[k], found_b[k], data[k] = [], [], b""
        counts_a, counts_b = (np.array([len(x) for x in found], np.int64) for found in (found_a, found_b))
        flat_a, flat_b = (np.fromiter(itertools.chain.from_iterable(f), np.int64) for f in (found_a, found_b))
        end_a, end_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        ends = np.cumsum(np.array([len(d) for d in data], np.int64))
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(common)), np.bincount(group_b, minlength=len(common))
        owner = np.searchsorted(ends, common)  # the stretch of a group
        links = in_a * in_b
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        wide: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for g in np.flatnonzero(links > WIDE_GROUP).tolist():
            a, times_a = np.unique(flat_a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            b, times_b = np.unique(flat_b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            wide.setdefault(int(owner[g]), []).append(((a[:, None] << 32 | b).ravel(), (times_a[:, None] * times_b).ravel()))
        partners = np.where(links > WIDE_GROUP, 0, in_b)[group_a]
        total = int(partners.sum())
        left = np.repeat(np.arange(len(flat_a)), partners)
        within = np.arange(total) - np.repeat(np.cumsum(partners) - partners, partners)
        codes = flat_a[left] << 32 | flat_b[first_b[group_a[left]] + within]
        n = len(stretches)
        texts_a, texts_b = ([names[i] for i in flat.tolist()] for names, flat in ((self.name_a, flat_a), (self.name_b, flat_b)))
        bounds = zip(first_a.tolist(), in_a.tolist(), first_b.tolist(), in_b.tolist())
        described = [f"{','.join(texts_a[i : i + k])}|{','.join(texts_b[j : j + m])}" for i, k, j, m in bounds]
        n_groups = np.bincount(owner, minlength=n)
        cuts = np.r_[0, np.cumsum(n_groups)].tolist()
        return Aligned(
            right,
            counts_a,
            counts_b,
            n_groups,
            np.bincount(owner, weights=links, minlength=n).astype(np.int64),
            codes,
            np.bincount(owner[group_a[left]], minlength=n),
            wide,
            [";".join(described[i:j]) for i, j in zip(cuts, cuts[1:])],
        )

    def learn(self, new: list[str]) -> None:
        """Add stretches to the store, a bounded number of bytes at a time."""
        start = 0
        while start < len(new):
            stop, size = start, 0
            while stop < len(new) and (size < LEARN_BYTES or stop == start):
                size += len(new[stop])
                stop += 1
            found, old, base = self.align(new[start:stop]), self.store, len(self.known)
            self.known.update(zip(new[start:stop], range(base, base + stop - start)))
            joined = {name: np.concatenate([getattr(old, name), getattr(found, name)]) for name in ("right", "n_a", "n_b", "n_groups", "n_links", "codes", "code_counts")}
            self.store = Aligned(**joined, wide={**old.wide, **{base + k: v for k, v in found.wide.items()}}, groups=old.groups + found.groups)
            start = stop

    def stretches(self, text: str) -> list[str]:
        """The text, with a space in front, in stretches that both tokenizers treat by themselves; without that space each."""
        return _CUT.split(text) if _INNER_SPACE.search(text) else text.split(" ")


def _bitmap(numbers: np.ndarray) -> bytes:
    bits = np.zeros(BLOCK_DOCS, bool)
    bits[numbers] = True
    return np.packbits(bits, bitorder="little").tobytes()


def containers(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Bitmaps of stretches of sorted 16-bit document numbers: a list up to `SPARSE`, bits beyond."""
    numbers = numbers.astype("<u2")
    bounds = np.r_[0, np.cumsum(counts)]
    if (counts <= SPARSE).all():
        offsets = pa.py_buffer((2 * bounds).astype(np.int32).tobytes())
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets, pa.py_buffer(numbers.tobytes())])
    parts = zip(bounds.tolist(), bounds[1:].tolist())
    return pa.array([_bitmap(numbers[a:b]) if b - a > SPARSE else numbers[a:b].tobytes() for a, b in parts], pa.binary())


def members(bitmaps: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All document numbers of a column of bitmaps, and the row of each."""
    rows = np.repeat(np.arange(len(counts)), counts)
    values = bitmaps.to_pylist()
    for i in np.flatnonzero(counts > SPARSE).tolist():
        values[i] = np.flatnonzero(np.unpackbits(np.frombuffer(values[i], np.uint8), bitorder="little")).astype("<u2").tobytes()
    return np.frombuffer(b"".join(values), "<u2").astype(np.int64), rows


class Block:
    """Documents and links on their way into the index."""

    def __init__(self) -> None:
        self.docs = self.links = 0
        self.keys: list[np.ndarray] = []
        self.heavy: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, codes: np.ndarray, local: np.ndarray, times: np.ndarray | None = None) -> None:
        """Links of documents: the code's halves are packed to leave room for the number of the document."""
        key = ((codes >> 32) << 40) | ((codes & 0xFFFFFF) << DOC_BITS) | local
        self.links += len(key)
        if times is None:
            self.keys.append(key)
        else:
            self.heavy.append((key, times))

    def planes(self) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray, pa.Array]]:
        """`a`, `b`, plane, counts and bitmaps: documents that have the pair (plane 0), then planes of the multiplicity less one."""
        keys = np.sort(np.concatenate(self.keys)) if self.keys else np.empty(0, np.int64)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        times = np.diff(np.r_[first, len(keys)])
        keys = keys[first]
        if self.heavy:
            every = np.concatenate([keys, *(k for k, _ in self.heavy)])
            weight = np.concatenate([times, *(t for _, t in self.heavy)])
            keys, place = np.unique(every, return_inverse=True)
            times = np.zeros(len(keys), np.int64)
            np.add.at(times, place, weight)
        yield self._plane(keys, 0)
        more, plane = times - 1, 1
        while more.any():
            keys, more = keys[more > 0], more[more > 0]
            yield self._plane(keys[more & 1 == 1], plane)
            more, plane = more >> 1, plane + 1

    def _plane(self, keys: np.ndarray, plane: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray, pa.Array]:
        pair = keys >> DOC_BITS
        start = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.empty(0, np.int64)
        counts = np.diff(np.r_[start, len(pair)])
        return pair[start] >> 24, pair[start] & 0xFFFFFF, plane, counts, containers(keys & (BLOCK_DOCS - 1), counts)


POSTINGS = {"a": pa.int32(), "b": pa.int32(), "plane": pa.int32(), "n": pa.int32(), "docs": pa.binary()}
STATS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string(), "groups": pa.string()}


def _described(aligner: Aligner, texts: list[str], block: Block, keep_groups: bool) -> dict[str, list]:
    """The statistics of some texts; their links go to the block."""
    parts = [aligner.stretches(t) if t else [] for t in texts]
    flat = list(itertools.chain.from_iterable(parts))
    if len(aligner.known) > aligner.limit:
        aligner._forget()
    get = aligner.known.get
    index = list(map(get, flat))
    if None in index:
        aligner.learn(list(dict.fromkeys(s for s, i in zip(flat, index) if i is None)))
        index = [get(s) if i is None else i for s, i in zip(flat, index)]
    index, store = np.array(index, np.int64), aligner.store
    sizes = np.array([len(x) for x in parts], np.int64)
    n = len(texts)
    owner = np.repeat(np.arange(n), sizes)
    whole = {k: aligner.align([texts[k]]) for k in np.unique(owner[~store.right[index]]).tolist()}
    plain = ~np.isin(owner, list(whole))
    sums = {name: np.bincount(owner, weights=getattr(store, name)[index] * plain, minlength=n).astype(np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}

    local = block.docs + np.arange(n)
    at, doc = index[plain], local[owner[plain]]
    counts = store.code_counts[at]
    begin = (np.cumsum(store.code_counts) - store.code_counts)[at]
    total = int(counts.sum())
    block.add(store.codes[np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(total)], np.repeat(doc, counts))
    if store.wide:
        for k in np.flatnonzero(np.isin(at, list(store.wide))).tolist():
            for codes, times in store.wide[int(at[k])]:
                block.add(codes, doc[k], times)

    words, bounds = store.groups, np.r_[0, np.cumsum(sizes)].tolist()
    places = index.tolist()
    groups = [";".join([words[i] for i in places[a:b]]) for a, b in zip(bounds, bounds[1:])]
    for k, one in whole.items():
        groups[k] = one.groups[0]
        for name in sums:
            sums[name][k] = getattr(one, name)[0]
        block.add(one.codes, np.full(len(one.codes), local[k]))
        for codes, times in one.wide.get(0, []):
            block.add(codes, local[k], times)
    block.docs += n
    digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
    return {**sums, "groups_sha256": digests, "groups": groups if keep_groups else [None] * n}


@dataclass
class Index:
    """A written index: `documents` and `postings` read what the job committed."""

    table: DataFrame
    key: str

    @property
    def documents(self) -> DataFrame:
        """`block` and `local` (the document's number in the index), the key, and what is known of the document by itself."""
        return self.table.filter(F.col("a").isNull()).select("block", "local", self.key, *STATS)

    @property
    def postings(self) -> DataFrame:
        """`a`, `b`, `block`, `plane`, `n` (population count), `docs` (bitmap)."""
        return self.table.filter(F.col("a").isNotNull()).select("a", "b", "block", "plane", "n", "docs")

    def pairs(self) -> DataFrame:
        """`a`, `b`, `n_docs`, `n_links` of every pair, and whether no pair of `a` has more documents (`best`).

        Counts are added up in every task first; an id of A has no more pairs than B has ids.
        """
        weight = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
        counted = self.postings.groupBy("a", "b").agg(
            F.sum(F.when(F.col("plane") == 0, F.col("n")).otherwise(0)).alias("n_docs"), F.sum(F.col("n") * weight).alias("n_links")
        )
        return counted.withColumn("best", F.col("n_docs") == F.max("n_docs").over(W.partitionBy("a")))

    def scores(self) -> DataFrame:
        """`block`, `local`, `n_best`, `count_sum` of every document that has links."""
        code = F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long"))
        known = broadcast_if_small(self.pairs().select(code.alias("_code"), "n_docs", F.col("best").cast("int").alias("best")))
        rows = self.postings.withColumn("_pair", code).join(known, F.col("_pair") == F.col("_code"))
        rows = rows.select("block", "plane", "n", "docs", "n_docs", "best").repartition("block").sortWithinPartitions("block")
        return rows.mapInArrow(_returned, "block long, local int, n_best long, count_sum long")


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings, sorted by block, give their documents what their pairs are worth."""
    now = None
    best, total = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)

    def closed() -> pa.RecordBatch:
        some = np.flatnonzero(total)
        columns = [pa.array(np.full(len(some), now), pa.int64()), pa.array(some, pa.int32()), pa.array(best[some]), pa.array(total[some])]
        return pa.RecordBatch.from_arrays(columns, ["block", "local", "n_best", "count_sum"])

    for batch in batches:
        block, plane, n, worth, is_best = (batch.column(c).to_numpy() for c in ("block", "plane", "n", "n_docs", "best"))
        weight = np.int64(1) << np.maximum(plane - 1, 0).astype(np.int64)
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for i, j in zip(cuts, cuts[1:]):
            if j > i and block[i] != now:
                if now is not None:
                    yield closed()
                now = block[i]
                best[:] = total[:] = 0
            docs, rows = members(batch.column("docs").slice(i, j - i), n[i:j])
            np.add.at(total, docs, (worth[i:j] * weight[i:j])[rows])
            np.add.at(best, docs, (is_best[i:j] * weight[i:j])[rows])
    if now is not None:
        yield closed()


def build_index(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", keep_groups: bool = False, block_links: int = BLOCK_LINKS
) -> Index:
    """Align every document and write documents and postings to a table in the shared folder.

    With `keep_groups` the alignment itself is kept too, as text: `a1,a2|b1;a3|b2,b3`.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["block", "local", key, *STATS, *POSTINGS]
    schema = (
        f"block long, local int, `{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string,"
        " a int, b int, plane int, n int, docs binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        block = Block()
        key_type = None

        def closed() -> Iterator[pa.RecordBatch]:
            for a, b, plane, counts, bitmaps in block.planes():
                for i in range(0, len(a), 1 << 16):
                    m = len(a[i : i + (1 << 16)])
                    values = {
                        "block": pa.array(np.full(m, number), pa.int64()),
                        "a": pa.array(a[i : i + m], pa.int32()),
                        "b": pa.array(b[i : i + m], pa.int32()),
                        "plane": pa.array(np.full(m, plane), pa.int32()),
                        "n": pa.array(counts[i : i + m], pa.int32()),
                        "docs": bitmaps.slice(i, m),
                    }
                    empty = {"local": pa.int32(), key: key_type, **STATS}
                    yield pa.RecordBatch.from_arrays([values[c] if c in values else pa.nulls(m, empty[c]) for c in names], names)

        for batch in batches:
            key_type = batch.column(key).type
            for part, texts in chunks(batch, text):
                if block.docs + part.num_rows > BLOCK_DOCS or block.links >= block_links:
                    yield from closed()
                    block, number = Block(), number + 1
                m, first = part.num_rows, block.docs
                found = _described(aligner, [t.decode() for t in texts], block, keep_groups)
                values = {
                    "block": pa.array(np.full(m, number), pa.int64()),
                    "local": pa.array(np.arange(first, first + m), pa.int32()),
                    key: part.column(key),
                    **{name: pa.array(found[name], kind) for name, kind in STATS.items()},
                }
                yield pa.RecordBatch.from_arrays([values[c] if c in values else pa.nulls(m, POSTINGS[c]) for c in names], names)
        if block.docs:
            yield from closed()

    spark = docs.sparkSession
    path = scratch_path(spark, "alignment")
    docs.select(key, text).mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return Index(spark.read.schema(schema).parquet(path), key)


def score_documents(index: Index) -> DataFrame:
    """The key, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256` and `groups` of every document.

    A link's count is how many documents hold its pair of ids; it is best if no pair of its A id is in more documents.
    """
    scores = index.scores().select(F.col("block").alias("_block"), F.col("local").alias("_local"), "n_best", "count_sum")
    docs = index.documents
    joined = docs.join(scores, (F.col("block") == F.col("_block")) & (F.col("local") == F.col("_local")), "left")
    counted = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return joined.select(index.key, "n_a", "n_b", "n_groups", "n_links", *counted, "groups_sha256", "groups")
