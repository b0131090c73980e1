"""Exact repeats of `length` bytes across documents, by interval expansion on a Burrows-Wheeler transform.

A byte goes if it is covered by a string of `length` bytes that also starts in a document with a
smaller id. The rows are packed into blocks; then

1. every window of `length` bytes names its anchor, the string of `ANCHOR` bytes in it of least hash
   (the leftmost of equals), so equal windows have equal anchors at equal places;
2. blocks learn which of their anchors other blocks have too, and which occur more than `ANCHOR_RUNS` times;
3. the contexts of those (the bytes of all consecutive windows with one anchor) go to a bucket by
   anchor, each distinct one once from a block with its smallest id. Where an anchor has different contexts, they are
   joined to a text and its suffixes are divided by breadth-first backward extension over its
   Burrows-Wheeler transform: interval by interval, common prefixes are found in the order of their
   length, and expansion stops at `length`. Suffixes no boundary divides by then share `length`
   bytes, and the smallest id of such a class is what its windows learn;
   The windows of an anchor that occurs more often are contexts of their own and are dealt by a hash of the whole
   window, so that no bucket gets all of one anchor;
4. blocks mark the bytes of windows that a smaller id has.

Texts are UTF-8 bytes; a null is empty. Texts shorter than `length` have no windows. A row with a null id
comes after all others: it loses what they have and takes nothing from them. Rows of equal ids do
not take from each other. Each row gives a row, an empty table none. Only two columns are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from windrow.llm import exchange
from windrow.llm.arrow import text_bytes

LENGTH = 50
ANCHOR = 24
PIECE_BYTES = 1 << 16  # the arrays of a piece stay in a core's cache
TEXT_BYTES = 1 << 15
BLOCK_BYTES = 4 << 20  # a block's or a bucket's contexts have several times the bytes of its text, in Python objects
BUCKET_BYTES = 4 << 20
ANCHOR_RUNS = 1 << 11  # contexts of one anchor in a bucket
TEXT_LEVEL = 3  # of compression: a seventh smaller than by 1
LAST_ID = np.iinfo(np.int64).max

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ANCHOR bytes that begin at each place."""
    n = len(data) - ANCHOR + 1
    # eight bytes from each place, read as one number
    words = np.array(np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,)))
    h = words[:n] * _M1
    for k in range(8, ANCHOR, 8):
        h = (h ^ (h >> np.uint64(29)) ^ words[k : k + n]) * _M2
    h ^= h >> np.uint64(32)
    h *= _M1
    return h ^ (h >> np.uint64(29))


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts of about PIECE_BYTES, with the place of the first."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > PIECE_BYTES:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def anchors(texts: list[bytes], length: int = LENGTH) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joined texts; for each run of windows with one anchor: hash, first window, count of windows, anchor, text."""
    joined = b"".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    empty = np.empty(0, np.int64)
    if len(joined) < length:
        return joined, np.empty(0, np.uint64), empty, empty, empty, empty
    h = _hashes(np.frombuffer(joined, np.uint8))
    # the order of hashes, then the place: the least of a stretch is its leftmost least hash
    key = h >> np.uint64(32) << np.uint64(32) | np.arange(len(h), dtype=np.uint64)
    span = length - ANCHOR + 1
    least, width = key, 1
    while 2 * width <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    rest = span - width
    if rest:
        least = np.minimum(least[: len(least) - rest], least[rest:])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
    whole = np.arange(len(at)) + length <= ends[owner]
    change = np.flatnonzero((np.r_[-1, at[:-1]] != at) | np.r_[True, ~whole[:-1]] | (np.r_[-1, owner[:-1]] != owner))
    count = np.diff(np.r_[change, len(at)])
    ok = whole[change]
    # a run may end in windows that are not whole
    cum = np.r_[0, np.cumsum(whole)]
    count = cum[change + count] - cum[change]
    first = change[ok]
    return joined, h[at[first]], first, count[ok], at[first], owner[first]


def _question(row: dict, n: int, length: int) -> Iterator[tuple[int, bytes]]:
    batch = exchange.from_bytes(row["payload"])
    keys = [anchors(part, length)[1] for _, part in _pieces(text_bytes(batch.column("text")))]
    keys, times = np.unique(np.concatenate(keys) if keys else np.empty(0, np.uint64), return_counts=True)
    for bucket, places, low in exchange.keys_by_bucket(keys, n):
        total = np.bincount(np.searchsorted(low, exchange.in_bucket(keys[places], n)), times[places], len(low)).astype("<u4")
        often = np.flatnonzero(total > 1).astype("<u4")
        body = exchange.packed_keys(low)
        yield bucket, struct.pack("<II", len(body), len(often)) + body + often.tobytes() + total[often].tobytes()


def _shared(group: list[dict], limit: int) -> list[bytes]:
    """For every block's keys two rows of bits: does another block have it too, does it occur more than `limit` times?"""
    bare, lists, counts = [], [], []
    for row in group:
        size, k = struct.unpack_from("<II", row["body"])
        bare.append({"body": row["body"][8 : 8 + size]})
        lists.append(exchange.unpacked_keys(bare[-1]["body"]))
        counts.append(np.ones(len(lists[-1]), np.int64))
        counts[-1][np.frombuffer(row["body"], "<u4", k, 8 + size)] = np.frombuffer(row["body"], "<u4", k, 8 + size + 4 * k)
    every, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    many = every[np.bincount(inverse, np.concatenate(counts), len(every)) > limit]
    return [bits + np.packbits(np.isin(x, many)).tobytes() for bits, x in zip(exchange.shared_keys(bare), lists)]


class Contexts:
    """The contexts of a block whose anchors are shared, each distinct one once, in a fixed order.

    Of an anchor that occurs too often each window is a context, whose key is its hash and whose anchor has no place.
    """

    def __init__(self, row: dict, n: int, length: int):
        batch = exchange.from_bytes(row["payload"])
        self.ids = np.array([LAST_ID if x is None else x for x in batch.column("id").to_pylist()], np.int64)
        self.texts = text_bytes(batch.column("text"))
        found = [(start, *anchors(part, length)) for start, part in _pieces(self.texts)]
        keys = [f[2] for f in found]
        every = exchange.distinct(np.concatenate(keys)) if keys else np.empty(0, np.uint64)
        inverse = np.searchsorted(every, np.concatenate(keys)) if keys else np.empty(0, np.int64)
        owners = np.concatenate([f[6] + f[0] for f in found]) if found else np.empty(0, np.int64)
        shared, often = np.zeros(len(every), bool), np.zeros(len(every), bool)
        # anchors of two texts of this block
        low, high = np.full(len(every), LAST_ID), np.full(len(every), -1)
        np.minimum.at(low, inverse, owners)
        np.maximum.at(high, inverse, owners)
        shared |= low < high
        replies = exchange.reply_of(row)
        for bucket, places, values in exchange.keys_by_bucket(every, n):
            if bucket in replies:
                bits = np.frombuffer(replies[bucket], np.uint8).reshape(2, -1)
                bits = np.unpackbits(bits, axis=1, count=len(values)).astype(bool)
                at = np.searchsorted(values, exchange.in_bucket(every[places], n))
                shared[places] |= bits[0, at]
                often[places] = bits[1, at]
        #: per distinct context: its key and bytes, place of the anchor; per occurrence: context, text, first window
        self.known: dict[tuple[int, bytes, int], int] = {}
        which, text, place = [], [], []
        base = 0
        for start, joined, hashes, first, count, at, owner in found:
            number = inverse[base : base + len(hashes)]
            picked = np.flatnonzero(shared[number] & ~often[number])
            spread = np.flatnonzero(shared[number] & often[number])
            base += len(hashes)
            begin = np.cumsum([0, *map(len, self.texts[start : start + (int(owner[-1]) + 1 if len(owner) else 0)])])
            known = self.known
            for k, a, c, m in zip(hashes[picked].tolist(), first[picked].tolist(), count[picked].tolist(), at[picked].tolist()):
                which.append(known.setdefault((k, joined[a : a + c + length - 1], m - a), len(known)))
            text.append(owner[picked] + start)
            place.append(first[picked] - begin[owner[picked]])
            windows = np.repeat(first[spread] - np.r_[0, np.cumsum(count[spread])[:-1]], count[spread]) + np.arange(int(count[spread].sum())) if len(spread) else spread
            for a in windows.tolist():
                window = joined[a : a + length]
                which.append(known.setdefault((xxhash.xxh3_64_intdigest(window), window, -1), len(known)))
            holder = np.repeat(owner[spread], count[spread])
            text.append(holder + start)
            place.append(windows - begin[holder])
        self.which = np.array(which, np.int64)
        self.text = np.concatenate(text) if text else np.empty(0, np.int64)
        self.place = np.concatenate(place) if place else np.empty(0, np.int64)
        self.least, self.most = np.full(len(self.known), LAST_ID), np.full(len(self.known), np.iinfo(np.int64).min)
        np.minimum.at(self.least, self.which, self.ids[self.text])
        np.maximum.at(self.most, self.which, self.ids[self.text])

    def by_bucket(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """Contexts by the `n` buckets of anchors, then single windows by as many more."""
        keys = np.array([k for k, _, _ in self.known], np.uint64)
        single = np.array([at < 0 for _, _, at in self.known], bool)
        for base, mine in ((0, np.flatnonzero(~single)), (n, np.flatnonzero(single))):
            order = mine[np.argsort(keys[mine], kind="stable")]
            for bucket, stretch, _ in exchange.keys_by_bucket(keys[order], n):
                yield base + bucket, order[stretch]


def _packed(contexts: list[bytes], at: np.ndarray, least: np.ndarray, most: np.ndarray) -> bytes:
    """A message of contexts: the numbers, the bytes of one weight side by side, then the contexts.

    The key of a context is not sent, as it is the hash of bytes the context holds.
    """
    n, text = len(contexts), b"".join(contexts)
    # ids of any size come back, as the difference wraps around
    numbers = np.array([[len(c) for c in contexts], at, least, most - least], "<i8")
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(4, n, 8).transpose(0, 2, 1)).tobytes()
    codec = pa.Codec("zstd", compression_level=TEXT_LEVEL)
    planes = codec.compress(planes, asbytes=True)
    return struct.pack("<III", n, len(text), len(planes)) + planes + codec.compress(text, asbytes=True)


def _unpacked(body: bytes) -> tuple[list[bytes], list[int], list[int], list[int]]:
    """Contexts, places of their anchors (-1: a single window), smallest and largest ids."""
    n, size, head = struct.unpack_from("<III", body)
    planes = pa.decompress(body[12 : 12 + head], decompressed_size=32 * n, codec="zstd", asbytes=True)
    text = pa.decompress(body[12 + head :], decompressed_size=size, codec="zstd", asbytes=True)
    numbers = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, 8, n).transpose(0, 2, 1)).view("<i8")[..., 0]
    ends = np.cumsum(numbers[0])
    contexts = [text[a:b] for a, b in zip((ends - numbers[0]).tolist(), ends.tolist())]
    return contexts, numbers[1].tolist(), numbers[2].tolist(), (numbers[2] + numbers[3]).tolist()


def _contexts(row: dict, n: int, length: int) -> Iterator[tuple[int, bytes]]:
    found = Contexts(row, n, length)
    entries = list(found.known)
    for bucket, places in found.by_bucket(n):
        chosen = [entries[i] for i in places.tolist()]
        yield bucket, _packed([e[1] for e in chosen], np.array([e[2] for e in chosen], np.int64), found.least[places], found.most[places])


def divide(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of `text` and, at its places, whether a suffix differs from the one before within `length`.

    `text` holds numbers from 0; 0 closes a context, and no two closings are alike. The intervals of
    all strings of 0, 1, 2 ... bytes are extended backwards over the transform, all those of one length at
    once. An extension of which an end is not a boundary yet makes it one and goes on; the others have been met
    with a shorter string.
    """
    n = len(text)
    closing = np.cumsum(text == 0)
    rank = np.where(text == 0, closing, text.astype(np.int64) + closing[-1])
    step = 1
    while step < n:
        # places behind the end never matter: a closing has come before
        second = np.r_[rank[step:], np.zeros(min(step, n), np.int64)][:n]
        pair = rank * (int(rank.max()) + 2) + second
        values, rank = np.unique(pair, return_inverse=True)
        step *= 2
        if len(values) == n or step >= length:  # what follows further on cannot matter
            break
        rank = rank + 1
    order = np.argsort(rank, kind="stable")
    before = text[order - 1]  # the transform; the text ends in a closing
    # the place of the suffix that is one byte longer: those with equal bytes in front stay in order
    longer = np.empty(n, np.int64)
    longer[np.argsort(before, kind="stable")] = np.arange(n)
    boundary = np.zeros(n + 1, bool)
    boundary[: closing[-1] + 1] = True  # closings differ from everything
    boundary[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        alone = high - low == 1
        one = low[alone]
        one = longer[one[before[one] > 0]]
        # the places of all other intervals, by interval and byte in front: each such stretch is an extension
        start, size = low[~alone], (high - low)[~alone]
        done = np.cumsum(size)
        places = np.repeat(start - (done - size), size) + np.arange(int(size.sum()))
        key = np.repeat(np.arange(len(start)), size) << 9 | before[places]
        sort = np.argsort(key, kind="stable")
        key = key[sort]
        edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
        count = np.diff(np.r_[edge, len(key)])
        real = key[edge] & 511 > 0
        low = np.r_[one, longer[places[sort[edge[real]]]]]
        high = low + np.r_[np.ones(len(one), np.int64), count[real]]
        fresh = ~boundary[high] | ~boundary[low]
        boundary[low] = boundary[high] = True
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
    return order, boundary[:n]


def _settle(contexts: list[bytes], least: np.ndarray, length: int) -> list[list[tuple[int, int, int]]]:
    """For every context its runs of windows (from, count) with the smallest id that has them."""
    text = np.frombuffer(b"".join(x + b"\0" for x in contexts), np.uint8).astype(np.int64)
    sizes = np.array([len(x) + 1 for x in contexts])
    ends = np.cumsum(sizes)
    closing = np.zeros(len(text), bool)
    closing[ends - 1] = True
    text = np.where(closing, 0, text + 1)
    order, boundary = divide(text, length)
    owner = np.repeat(np.arange(len(contexts)), sizes)
    starts = np.flatnonzero(boundary)
    smallest = np.minimum.reduceat(least[owner[order]], starts)
    result = np.empty(len(text), np.int64)
    result[order] = np.repeat(smallest, np.diff(np.r_[starts, len(text)]))
    windows = np.flatnonzero(np.arange(len(text)) < ends[owner] - length)
    owner, result, place = owner[windows], result[windows], windows - (ends - sizes)[owner[windows]]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (result[1:] != result[:-1])])
    count = np.diff(np.r_[first, len(owner)])
    runs: list[list[tuple[int, int, int]]] = [[] for _ in contexts]
    for o, *run in zip(owner[first].tolist(), place[first].tolist(), count.tolist(), result[first].tolist()):
        runs[o].append(tuple(run))
    return runs


def _verdicts(group: list[dict], length: int) -> list[bytes | None]:
    """For each block: places of its contexts, windows in them (from, count) and the smaller id they have."""
    smallest: dict[bytes, int] = {}
    only: dict[bytes, bytes] = {}
    several: dict[bytes, dict[bytes, None]] = {}
    for row in group:
        for context, at, least, _ in zip(*_unpacked(row["body"])):
            if least < smallest.get(context, LAST_ID + 1):
                smallest[context] = least
            if at < 0:  # equal or different as a whole
                continue
            anchor = context[at : at + ANCHOR]
            one = only.setdefault(anchor, context)
            if one != context:
                several.setdefault(anchor, {one: None})[context] = None
    del only
    settled: dict[bytes, list[tuple[int, int, int]]] = {}
    lot: list[bytes] = []
    size = 0

    def flush() -> None:
        if lot:
            settled.update(zip(lot, _settle(lot, np.array([smallest[c] for c in lot]), length)))

    # windows of different anchors differ, so any lot of whole anchors can be divided by itself
    for found in several.values():
        lot += found
        size += sum(map(len, found))
        if size > TEXT_BYTES:
            flush()
            lot, size = [], 0
    flush()
    replies: list[bytes | None] = []
    for row in group:
        found = []
        contexts, _, _, largest = _unpacked(row["body"])
        for i, (context, most) in enumerate(zip(contexts, largest)):
            runs = settled.get(context)
            if runs is None:
                if smallest[context] < most:
                    found.append((i, 0, len(context) - length + 1, smallest[context]))
            else:
                found += [(i, *run) for run in runs if run[2] < most]
        columns = zip(np.array(found, np.int64).reshape(-1, 4).T, ("<u4", "<u4", "<u4", "<i8"))
        replies.append(struct.pack("<I", len(found)) + b"".join(x.astype(t).tobytes() for x, t in columns) if found else None)
    return replies


def _marked(row: dict, n: int, length: int) -> tuple[list[bytes], list[np.ndarray]]:
    """Texts, and the bytes of each that go."""
    found = Contexts(row, n, length)
    spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    # occurrences of each context
    order = np.argsort(found.which, kind="stable")
    starts = np.searchsorted(found.which[order], np.arange(len(found.known) + 1))
    replies = exchange.reply_of({"replies": row["verdicts"]})
    for bucket, places in found.by_bucket(n):
        if bucket not in replies:
            continue
        body = replies[bucket]
        (k,) = struct.unpack_from("<I", body)
        where, begin, count = (np.frombuffer(body, "<u4", k, 4 + 4 * k * i).astype(np.int64) for i in range(3))
        ids = np.frombuffer(body, "<i8", k, 4 + 12 * k)
        context = places[where]
        times = starts[context + 1] - starts[context]
        total = np.cumsum(times)
        seen = order[np.repeat(starts[context] - (total - times), times) + np.arange(int(total[-1]))]
        begin, count, ids = (np.repeat(x, times) for x in (begin, count, ids))
        text = found.text[seen]
        ok = ids < found.ids[text]
        spans.append((text[ok], found.place[seen][ok] + begin[ok], count[ok] + length - 1))
    sizes = np.array([len(t) for t in found.texts], np.int64)
    base = np.cumsum(sizes) - sizes
    change = np.zeros(int(sizes.sum()) + 1, np.int32)
    for text, at, size in spans:
        np.add.at(change, base[text] + at, 1)
        np.add.at(change, base[text] + at + size, -1)
    gone = np.cumsum(change)[:-1] > 0
    return found.texts, [gone[b : b + s] for b, s in zip(base.tolist(), sizes.tolist())]


def _judged(docs: DataFrame, key: str, text: str, length: int, anchor_runs: int) -> tuple[DataFrame, int]:
    """Blocks with the verdicts on their contexts, and the number of buckets."""
    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    blocks = exchange.pack(rows, "repeats", limit=BLOCK_BYTES)
    n = exchange.bucket_count(blocks, BUCKET_BYTES)
    shared = exchange.answers(exchange.ask(blocks, lambda row: _question(row, n, length)), lambda g: _shared(g, anchor_runs), "shared")
    asked = blocks.join(shared, "block", "left")
    verdicts = exchange.answers(exchange.ask(asked, lambda row: _contexts(row, n, length)), lambda g: _verdicts(g, length), "verdicts")
    return asked.join(verdicts.withColumnRenamed("replies", "verdicts"), "block", "left"), n


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor_runs: int = ANCHOR_RUNS) -> DataFrame:
    """`key`, `text` (what is left, as bytes) and `removed` (spans of bytes) of every document."""
    judged, n = _judged(docs, key, text, length, anchor_runs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                ids = exchange.from_bytes(row["payload"]).column("id")
                texts, gone = _marked(row, n, length)
                left, spans = [], []
                for value, mask in zip(texts, gone):
                    edges = np.flatnonzero(np.diff(np.r_[False, mask, False])).tolist() if mask.any() else []
                    pairs = list(zip(edges[::2], edges[1::2]))
                    spans.append([{"start": a, "stop": b} for a, b in pairs])
                    left.append(b"".join(value[a:b] for a, b in zip([0, *(s for _, s in pairs)], [*(s for s, _ in pairs), len(value)])))
                for a in range(0, len(left), 256):
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(a, 256), pa.array(left[a : a + 256], pa.binary()), pa.array(spans[a : a + 256], SPANS)],
                        [key, "text", "removed"],
                    )

    return judged.mapInArrow(run, f"`{key}` long, text binary, removed array<struct<start:long,stop:long>>")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
