"""Byte-level BPE: boundaries from a scan of transition functions, then cached pair merging.

Every code point has a class; a class is a function on the states of a small automaton. Functions
compose associatively and their closure is finite, so the state in front of every code point comes
from a prefix scan over composition-table look-ups; no regular expression is run. The slices
between boundaries are merged by rank, once per distinct slice and worker (bounded cache).

Texts: null counts as empty, an empty text has no tokens, length is not limited. Rows are treated
one by one, so repeated rows, repeated or null ids give a row each; an empty table gives none.
Only the two columns named are read, whatever else the table holds.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from windrow.llm.arrow import chunks

CACHE_ENTRIES = 1 << 18
LONG_PIECE = 64

# fixed values: the code points of the Unicode property White_Space other than U+0020
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# fixed values: endings that an apostrophe at the start of a slice takes with it: s t m d, re ve, ll
SHORT_ENDINGS, E_ENDINGS, L_ENDINGS = "stmd", "rv", "l"

RESET, OTHER, APOSTROPHE, SPACE, WHITE, NUMBER, LETTER, SHORT, BEFORE_E, LETTER_L, LETTER_E = range(11)
START, IN_WORD, IN_NUMBER, IN_OTHER, QUOTE, WAITS_E, WAITS_L, CLOSED, AFTER_SPACE, AFTER_WHITE = range(10)
STATES, CLASSES = 10, 11
HERE, BEFORE = 1, 2  # a slice starts at this code point, at the one before


def _step(state: int, cls: int) -> tuple[int, int]:
    """The next state, and where slices start."""
    waiting = BEFORE if state in (WAITS_E, WAITS_L) else 0
    if cls == RESET:
        return START, waiting
    if cls in (SPACE, WHITE):
        inside = state in (AFTER_SPACE, AFTER_WHITE)
        return (AFTER_SPACE if cls == SPACE else AFTER_WHITE), 0 if inside else HERE | waiting
    lead = {AFTER_SPACE: BEFORE, AFTER_WHITE: BEFORE | HERE}.get(state, HERE | waiting)
    if cls == NUMBER:
        return IN_NUMBER, 0 if state == IN_NUMBER else lead
    if cls in (OTHER, APOSTROPHE):
        if state in (IN_OTHER, QUOTE):
            return IN_OTHER, 0
        return (QUOTE if cls == APOSTROPHE and state != AFTER_SPACE else IN_OTHER), lead
    if state == QUOTE:
        after = {SHORT: CLOSED, BEFORE_E: WAITS_E, LETTER_L: WAITS_L}.get(cls)
        return (IN_WORD, HERE) if after is None else (after, 0)
    if (state, cls) in ((WAITS_E, LETTER_E), (WAITS_L, LETTER_L)):
        return CLOSED, 0
    if waiting:
        return IN_WORD, BEFORE
    return IN_WORD, 0 if state == IN_WORD else lead


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class of a code point, function of a class, composition, state after a function, marks."""
    classes = np.full(0x110000, OTHER, np.uint8)
    kinds = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(0x110000)).encode(), np.uint8)
    classes[kinds == ord("L")] = LETTER
    classes[kinds == ord("N")] = NUMBER
    classes[list(WHITE_SPACE)] = WHITE
    for text, cls in ((" ", SPACE), ("'", APOSTROPHE), (SHORT_ENDINGS, SHORT), (E_ENDINGS, BEFORE_E), (L_ENDINGS, LETTER_L), ("e", LETTER_E)):
        classes[[ord(c) for c in text]] = cls
    single = [tuple(_step(s, c)[0] for s in range(STATES)) for c in range(CLASSES)]
    known = {f: i for i, f in enumerate(dict.fromkeys(single))}
    queue = list(known)
    while queue:
        f = queue.pop()
        for g in single:
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                queue.append(h)
    functions = list(known)
    compose = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    marks = np.array([[_step(s, c)[1] for c in range(CLASSES)] for s in range(STATES)], np.uint8)
    return classes, np.array([known[f] for f in single], np.uint16), compose, np.array([f[START] for f in functions], np.uint8), marks


def _scan(x: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition, by pairs: about two look-ups an element."""
    if len(x) == 1:
        return x
    half = len(x) // 2
    pairs = _scan(compose[x[0 : 2 * half : 2], x[1::2]], compose)
    out = np.empty_like(x)
    out[0] = x[0]
    out[1::2] = pairs
    rest = x[2::2]
    out[2::2] = compose[pairs[: len(rest)], rest]
    return out


def _code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the place where each begins; 0xFF is its own."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    points = data[first].astype(np.uint32)
    for lead, low, bits, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0xF8, 0x07, 3)):
        at = np.flatnonzero((points >= lead) & (points < low)) if more else None
        if len(at):
            value = data[first[at]].astype(np.uint32) & bits
            for k in range(1, more + 1):
                value = value << 6 | (data[first[at] + k].astype(np.uint32) & 0x3F)
            points[at] = value | 0x80000000  # marked, so that a later pass does not take it for a lead byte
    return points & 0x7FFFFFFF, first


def boundaries(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Texts joined by 0xFF bytes, where slices begin, and which of those are separators."""
    classes, of_class, compose, state_of, marks = _tables()
    joined = b"\xff" + b"\xff".join(texts) + b"\xff"
    data = np.frombuffer(joined, np.uint8)
    points, first = _code_points(data)
    cls = classes[points]
    breaks = data[first] == 0xFF
    cls[breaks] = RESET
    state = state_of[_scan(of_class[cls], compose)]
    seen = marks[state[:-1], cls[1:]]
    starts = breaks.copy()
    starts[1:] |= (seen & HERE) > 0
    starts[:-1] |= (seen & BEFORE) > 0
    at = first[starts]
    return joined, at, data[at] == 0xFF


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the pair of lowest rank, the leftmost of equals, until no pair has a rank (by a heap)."""
    n = len(piece)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = right[i] if right[i] >= 0 else n
        if j >= n or end[j] != stop:
            continue
        end[i], right[i] = stop, right[j]
        if right[j] < n:
            left[right[j]] = i
        right[j], end[j] = -1, -1
        for a in (left[i], i):
            if a >= 0 and right[a] < n and (r := ranks.get(piece[a : end[right[a]]])) is not None:
                heapq.heappush(heap, (r, a, end[right[a]]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = right[i]
    return out


@functools.cache
def _pairs(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that together are a token: sorted keys, and the token's rank."""
    ranks = _ranks(path)[0]
    found = sorted(
        (a << 32 | b, rank)
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if (a := ranks.get(token[:cut])) is not None and (b := ranks.get(token[cut:])) is not None
    )
    return np.array([x[0] for x in found], np.int64), np.array([x[1] for x in found], np.int64)


NO_PAIR = np.int64(1) << 62


def merge_many(pieces: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces one after the other, and how many each piece has.

    Every round joins, in each piece at once, its pair of lowest rank (the leftmost of equals) and
    looks up the two pairs that this makes.
    """
    ranks, tokens = _ranks(path)
    keys, values = _pairs(path)
    single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)

    def rank_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 32 | b
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, values[at], NO_PAIR)

    sizes = np.array([len(p) for p in pieces], np.int64)
    long = np.flatnonzero(sizes > LONG_PIECE)
    slow = {int(i): merge_long(pieces[i], ranks) for i in long}
    begin = np.cumsum(sizes) - sizes
    token = single[np.frombuffer(b"".join(pieces), np.uint8)]
    n = len(token)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    rank = np.full(n + 1, NO_PAIR)
    rank[: n - 1] = rank_of(token[:-1], token[1:])
    rank[begin + sizes - 1] = NO_PAIR
    alive = np.ones(n, bool)
    active = np.flatnonzero((sizes > 1) & (sizes <= LONG_PIECE))
    place = np.arange(n)
    while len(active):
        # the slots of the active pieces, one after the other
        lens = sizes[active]
        starts = np.cumsum(lens) - lens
        slots = np.repeat(begin[active] - starts, lens) + place[: int(lens.sum())]
        best = np.minimum.reduceat(np.minimum(rank[slots], 1 << 30) << 32 | slots, starts)
        going = best < 1 << 62
        active, i = active[going], best[going] & 0xFFFFFFFF
        j = after[i]
        token[i] = rank[i]
        alive[j] = False
        rank[j] = NO_PAIR
        after[i] = after[j]
        inner = after[i] < begin[active] + sizes[active]
        before[after[i[inner]]] = i[inner]
        rank[i] = NO_PAIR
        rank[i[inner]] = rank_of(token[i[inner]], token[after[i[inner]]])
        left = i[i > begin[active]]
        rank[before[left]] = rank_of(token[before[left]], token[left])
    counts = np.add.reduceat(alive.astype(np.int64), begin)
    if not slow:
        return token[alive], counts
    parts = np.split(token[alive], np.cumsum(counts)[:-1])
    for k, ids in slow.items():
        parts[k], counts[k] = np.array(ids, np.int64), len(ids)
    return np.concatenate(parts), counts


@functools.cache
def _ranks(path: str) -> tuple[dict[bytes, int], list[bytes]]:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


class Encoder:
    """Encodes batches of texts; remembers up to `limit` distinct slices."""

    def __init__(self, path: str, limit: int = CACHE_ENTRIES):
        self.path, self.tokens = path, _ranks(path)[1]
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {b"\xff": 0}
        self.flat, self.counts = np.empty(0, np.int64), np.zeros(1, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        new = list(dict.fromkeys(pieces))
        self.known.update(zip(new, range(len(self.counts), len(self.counts) + len(new))))
        ids, counts = merge_many(new, self.path)
        self.flat, self.counts = np.concatenate([self.flat, ids]), np.concatenate([self.counts, counts])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        joined, at, separator = boundaries(texts)
        stops = at.tolist()
        pieces = [joined[a:b] for a, b in zip(stops, stops[1:] + [len(joined)])]
        if len(self.known) > self.limit:
            self._forget()
        get = self.known.get
        index = list(map(get, pieces))
        if None in index:
            self._learn([p for p, i in zip(pieces, index) if i is None])
            index = [get(p) if i is None else i for p, i in zip(pieces, index)]
        index = np.array(index)
        counts = self.counts[index]
        bounds = np.cumsum(self.counts) - self.counts
        done = np.cumsum(counts)
        total = int(done[-1])
        ids = self.flat[np.repeat(bounds[index] - (done - counts), counts) + np.arange(total)]
        cuts = done[separator].tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The byte of the text where each token begins."""
        sizes = self.sizes[ids]
        return np.cumsum(sizes) - sizes


def decode_ids(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    return b"".join([tokens[i] for i in ids.tolist()])


def decode_range(ids: np.ndarray, offsets: np.ndarray, tokens: list[bytes], start: int, stop: int) -> bytes:
    """The bytes [start, stop) of a text, decoding only the tokens that touch them."""
    if stop <= start or not len(ids):
        return b""
    a = int(np.searchsorted(offsets, start, "right")) - 1
    b = int(np.searchsorted(offsets, stop, "left"))
    return decode_ids(ids[a:b], tokens)[start - int(offsets[a]) : stop - int(offsets[a])]


def encode(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `ids` and `offsets` of every row: little-endian 32-bit numbers, one for each token."""
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, ids binary, offsets binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path)
        for batch in batches:
            for part, texts in chunks(batch, text):
                found = encoder.encode(texts)
                packed = [[x.astype("<u4").tobytes() for x in y] for y in (found, map(encoder.offsets, found))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), *(pa.array(x, pa.binary()) for x in packed)], [key, "ids", "offsets"]
                )

    return docs.select(key, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str, key: str = "doc_id") -> DataFrame:
    """`key` and `decoded`, the bytes that the ids stand for."""
    schema = f"`{key}` {encoded.schema[key].dataType.simpleString()}, decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _ranks(ranks_path)[1]
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = [decode_ids(np.frombuffer(x or b"", "<u4"), tokens) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(texts, pa.binary())], [key, "decoded"])

    return encoded.select(key, "ids").mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode the ids, and report both: `key`, `n_tokens`, `ids_sha256`, `decoded_sha256`.

    One pass in one worker; ids and bytes are not kept.
    """
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks_path)
        names = [str(i) for i in range(len(encoder.tokens))]
        sha = hashlib.sha256
        for batch in batches:
            for part, texts in chunks(batch, text):
                ids = encoder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([sha(",".join([names[i] for i in x.tolist()]).encode()).hexdigest() for x in ids]),
                        pa.array([sha(decode_ids(x, encoder.tokens)).hexdigest() for x in ids]),
                    ],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(key, text).mapInArrow(run, schema)
