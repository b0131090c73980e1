"""Main text of web pages: markup first, then long substrings that pages of a host share.

The markup gives blocks in page order. Elements that never hold main text (menus, page headers, footers, asides, forms,
scripts, styles) and those whose class, id or role says so are noise. Outside `article` and `main` any word of a class or id may
say so; inside, only a name that consists of such words and of words for layout (`comment-list`, but not `ad-free` or `article-header`).

The blocks that remain form a page's stream of words, and all streams of a host one text. Its suffixes, cut at `words`
words and not running across pages, are sorted by host and content; neighbours that agree in all of
them are a substring repeated on distinct pages, whatever its full length. The order is spread over buckets by a 64-bit fingerprint of
the cut suffix with its host, so a large host is no large group, and a page block sends each cut suffix once. A block that such
repeats cover wholly is boilerplate of the host and goes, unless it lies in an `article` or `main` element: what authors
marked as the text stays even where another page repeats it. Everything else stays: what is marked, and every unique run of
blocks beside it. Suffixes that touch marked text only decide nothing and are left out.

Pages are distinct if their blocks differ: the same page under several addresses of a host, or in repeated rows, is one page when
repeats are counted, and each row gives a row. A null or empty page has an empty text. Pages of a null url share a host of their
own. Texts are never cut. Only the columns named are read; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.llm import exchange
from windrow.llm.url_filter import host_of
from windrow.session import scratch_path

REPEAT_WORDS = 6

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)

# fixed values: names of HTML elements
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
NOISE = frozenset("head nav footer aside form button select option dialog menu object canvas header".split())
MAIN = frozenset(["article", "main"])
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal"
    " overlay nav navbar navigation menu breadcrumb breadcrumbs header footer sidebar aside widget related share sharing social"
    " subscribe newsletter signup login comment comments disqus reply replies respond pagination pager toolbar"
    " contentinfo complementary search dialog alert form".split()
)
# words that say how a noise element is laid out, not what is in it
LAYOUT_WORDS = frozenset(
    "area bar block body box button buttons card cards column container content group inner item items left link links list main"
    " outer panel post posts right row section slot text title unit wrap wrapper".split()
)
_END_RAW = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_WORD = re.compile(r"[a-zA-Z]+")


def _says_noise(value: str, inside_main: bool) -> bool:
    """Does a class, id or role name what holds no main text?"""
    if not inside_main:
        return not NOISE_WORDS.isdisjoint(_WORD.findall(value))
    for name in value.split():
        words = set(_WORD.findall(name))
        if words & NOISE_WORDS and words <= NOISE_WORDS | LAYOUT_WORDS:
            return True
    return False


def _noisy(name: str, attributes: str, inside_main: bool) -> bool:
    if name in NOISE and not (name == "header" and inside_main):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for found in ATTRIBUTE.finditer(attributes):
        kind, value = found[1].lower(), (found[2] or "").strip("\"'").lower()
        if kind == "hidden" or (kind == "aria-hidden" and value == "true"):
            return True
        if kind == "style":
            if "display:none" in value.replace(" ", ""):
                return True
        elif kind != "aria-hidden" and _says_noise(value, inside_main):
            return True
    return False


def blocks_of(page: str) -> list[tuple[str, bool]]:
    """Blocks that are not noise, in page order: text, and whether a main element holds it."""
    blocks: list[tuple[str, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, is noise, is main
    noise = main = 0

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            blocks.append((text, main > 0))
        parts.clear()

    at, end = 0, len(page)
    while at < end:
        tag = TAG.search(page, at)
        stop = tag.start() if tag else end
        if stop > at and not noise:
            parts.append(page[at:stop])
        if tag is None:
            break
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            close()
        if tag[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    for _, was_noise, was_main in stack[depth:]:
                        noise -= was_noise
                        main -= was_main
                    del stack[depth:]
                    break
            continue
        if name in RAW:
            over = _END_RAW[name].search(page, at)
            at = over.end() if over else end
            continue
        if name in VOID:
            continue
        is_noise, is_main = _noisy(name, tag[3], main > 0), name in MAIN
        if is_noise and name in INLINE:
            close()
        stack.append((name, is_noise, is_main))
        noise += is_noise
        main += is_main
    close()
    return blocks


def _parse(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [blocks_of(x or "") for x in batch.column("html").to_pylist()]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id"),
            batch.column("url"),
            batch.column("host"),
            pa.array([[t for t, _ in f] for f in found], pa.list_(pa.string())),
            pa.array([[m for _, m in f] for f in found], pa.list_(pa.bool_())),
        ],
        ["id", "url", "host", "texts", "main"],
    )


_M = np.uint64(0x9E3779B97F4A7C15)


def _suffixes(host: str, texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the suffixes cut at `words` words (of those long enough), and words of each block."""
    split = [t.split() for t in texts]
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for s in split for w in s], np.uint64)
    sizes = np.array([len(s) for s in split], np.int64)
    n = len(hashes) - words + 1
    if n <= 0:
        return np.empty(0, np.uint64), sizes
    key = np.full(n, digest(host), np.uint64)
    for k in range(words):
        key = (key ^ (key >> np.uint64(31)) ^ hashes[k : k + n]) * _M
    return key ^ (key >> np.uint64(32)), sizes


class _Page(NamedTuple):
    texts: list[str]
    main: list[bool]
    sizes: np.ndarray  # words of each block
    places: np.ndarray  # where suffixes begin that touch a block outside the main element
    keys: np.ndarray  # their fingerprints
    content: int  # fingerprint of host and blocks


def _pages(row: dict, words: int) -> list[_Page]:
    batch = exchange.from_bytes(row["payload"])
    pages = []
    for host, texts, main in zip(*(batch.column(c).to_pylist() for c in ("host", "texts", "main"))):
        if all(main):  # nothing to decide, also for a page without blocks
            pages.append(_Page(texts, main, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), 0))
            continue
        keys, sizes = _suffixes(host or "", texts, words)
        outside = np.r_[0, np.cumsum(np.repeat(~np.array(main), sizes))]
        places = np.flatnonzero(outside[words:] > outside[:-words]) if len(keys) else np.empty(0, np.int64)
        content = xxhash.xxh3_64_intdigest("\0".join([host or "", *texts]))
        pages.append(_Page(texts, main, sizes, places, keys[places], content))
    return pages


def _contents(row: dict, words: int) -> np.ndarray:
    """Fingerprints of the pages of a block that have something to decide."""
    return np.unique(np.array([p.content for p in _pages(row, words) if len(p.places)], np.uint64))


def _distinct(row: dict, words: int) -> tuple[list[_Page], np.ndarray, np.ndarray]:
    """Pages of a block, its distinct suffix fingerprints, and for each how many of the pages that this block counts have it (2: more)."""
    pages = _pages(row, words)
    every = exchange.distinct(np.concatenate([p.keys for p in pages]))
    mine = {c & 0xFFFFFFFFFFFFFFFF: p for p, c in enumerate(row["counted"] or [])}
    low, high = np.full(len(every), len(mine)), np.full(len(every), -1)
    for p in pages:
        number = mine.get(p.content) if len(p.places) else None
        if number is not None:
            at = np.searchsorted(every, p.keys)
            low[at], high[at] = np.minimum(low[at], number), np.maximum(high[at], number)
    return pages, every, np.where(high < 0, 0, np.where(low < high, 2, 1)).astype(np.uint8)


def _packed(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as differences, the bytes of one weight side by side, then how often each counts."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(keys).to_bytes(4, "little") + pa.compress(planes + times.tobytes(), codec="zstd", asbytes=True)


def _unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(body[:4], "little")
    data = np.frombuffer(pa.decompress(body[4:], decompressed_size=9 * n, codec="zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(data[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64), data[8 * n :]


def _stretches(keys: np.ndarray, n: int) -> Iterator[tuple[int, slice]]:
    """The buckets that sorted keys fall into, and where."""
    bucket = exchange.bucket_of(keys, n)
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(keys)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield int(bucket[a]), slice(a, b)


def _question(row: dict, n: int, words: int) -> Iterator[tuple[int, bytes]]:
    _, every, times = _distinct(row, words)
    for bucket, at in _stretches(every, n):
        yield bucket, _packed(every[at], times[at])


def _answer(group: list[dict]) -> list[bytes]:
    """For every block's keys a bit each: do two distinct pages or more have it?"""
    lists = [_unpacked(row["body"]) for row in group]
    every, place = np.unique(np.concatenate([k for k, _ in lists]), return_inverse=True)
    total = np.bincount(place, np.concatenate([t for _, t in lists]), len(every))
    bits = np.split(total[place] > 1, np.cumsum([len(k) for k, _ in lists])[:-1])
    return [np.packbits(x).tobytes() for x in bits]


def _covered(seen: np.ndarray, sizes: np.ndarray, words: int) -> np.ndarray:
    """Which blocks lie wholly in repeated substrings."""
    total = int(sizes.sum())
    change = np.zeros(total + 1, np.int32)
    at = np.flatnonzero(seen)
    np.add.at(change, at, 1)
    np.add.at(change, at + words, -1)
    inside = np.r_[0, np.cumsum(np.cumsum(change)[:-1] > 0)]
    ends = np.cumsum(sizes)
    return (inside[ends] - inside[ends - sizes] == sizes) & (sizes > 0)


def _texts(row: dict, n: int, words: int) -> list[str]:
    pages, every, _ = _distinct(row, words)
    shared = np.zeros(len(every), bool)
    replies = exchange.reply_of(row)
    for bucket, at in _stretches(every, n):
        if bucket in replies:
            shared[at] = np.unpackbits(np.frombuffer(replies[bucket], np.uint8), count=at.stop - at.start).astype(bool)
    out = []
    for p in pages:
        if len(p.places):
            seen = np.zeros(max(int(p.sizes.sum()) - words + 1, 0), bool)
            seen[p.places] = shared[np.searchsorted(every, p.keys)]
            covered = _covered(seen, p.sizes, words).tolist()
            out.append(" ".join(t for t, m, c in zip(p.texts, p.main, covered) if m or not c))
        else:
            out.append(" ".join(p.texts))
    return out


def _counted(blocks: DataFrame, words: int) -> DataFrame:
    """`block`, `counted`: contents that the block counts for all blocks that have them. A number a page is moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                found = _contents(row, words)
                columns = [pa.array(found.view(np.int64)), pa.array(np.full(len(found), row["block"]), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["content", "block"])

    first = blocks.mapInArrow(run, "content long, block long").groupBy("content").agg(F.min("block").alias("block"))
    path = scratch_path(blocks.sparkSession, "contents")
    first.groupBy("block").agg(F.sort_array(F.collect_list("content")).alias("counted")).write.parquet(path)
    return blocks.sparkSession.read.schema("block long, counted array<long>").parquet(path)


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", words: int = REPEAT_WORDS) -> DataFrame:
    """`key`, `url` and `text` of every page."""
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(page).alias("html"))

    # blocks of bounded size, parsed once
    blocks = exchange.pack(rows, "pages", _parse)
    n = exchange.bucket_count(blocks)
    counted = blocks.join(_counted(blocks, words), "block", "left")
    shared = exchange.answers(exchange.ask(counted, lambda row: _question(row, n, words)), _answer, "boilerplate")
    asked = counted.join(shared, "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                held = exchange.from_bytes(row["payload"])
                texts = pa.array(_texts(row, n, words), pa.string())
                yield pa.RecordBatch.from_arrays([held.column("id"), held.column("url"), texts], [key, url, "text"])

    return asked.mapInArrow(run, f"`{key}` {kind}, `{url}` string, text string")
