"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

A shelf of words is indexed by bits: for each position and letter, a bitset says which words have that letter
there. All words of a shelf are looked up at once. While a word's letters are read, four bitsets go along, each a
few machine words wide: the words that agree so far, and those with one error behind them, be it
a replaced letter (read at the same position), a letter more (read one position later) or a letter less
(one position earlier). The bits are in order of falling counts, so the lowest bit that is
left is the best near word.

Which words meet on a shelf: of two near words, the shorter of length c, the first c // 2 letters are equal
or the last c // 2. So a word of length m joins the groups of its beginning and its end for
c = m and c = m - 1. Groups are packed on shelves in sorted order; a group larger than `tile` is cut by a hash of the
word, and each pair of tiles is a group of its own. A pair is counted in one group only: in that of the end only if the
beginnings differ. A shelf hands on a count and the best word for each word, never pairs.

Null texts have no words; a null id counts as an empty text where words are changed by id. Words of any length are read to
their end. Ties in counts go to the smaller word in code-point order. An empty table gives an empty result.
Only the columns named are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.operators.small_side import broadcast_if_small
from windrow.session import scratch_path

RUNS = "[A-Za-z\\u00C0-\\u00FF]+"
MIN_LENGTH, MIN_COUNT, FORM_FACTOR = 6, 5, 5
SHELF, TILE = 1024, 2048
SHELF_LETTERS = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def count_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    change: Callable[[Column, Column], Column] | None = None,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """`word`, `n`: runs of letters, A-Z lower-cased, counted over all documents; `change(id, run)` may alter a run first.

    Counts are added up in every task before rows are moved.
    """
    runs = docs.select(F.col(key).alias("_id"), F.explode(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(RUNS), F.lit(0))).alias("_run"))
    word = F.translate("_run", UPPER, LOWER)
    if change:
        word = change(F.coalesce(F.col("_id").cast("string"), F.lit("")), word)
    words = runs.select(word.alias("word")).filter(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def lost_letter(every: int) -> Callable[[Column, Column], Column]:
    """A change that takes a letter from one run in about `every`: the CRC-32 of `<id>:<run>` says from which, and where."""

    def change(key: Column, run: Column) -> Column:
        crc = F.crc32(F.concat(key, F.lit(":"), run))
        at = (crc % F.length(run)).cast("int")
        shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
        return F.when(crc % every == 0, shorter).otherwise(run)

    return change


def _groups(words: DataFrame, min_length: int, tile: int) -> DataFrame:
    """`class`, `part` (what is equal, and at which end), `low`, `high` (tiles), `side`, `word`, `n`."""
    size = F.length("word")

    def member(c: Column, end: int) -> Column:
        half = F.floor(c / 2).cast("int")
        letters = F.substring("word", size - half + 1, half) if end else F.substring("word", F.lit(1), half)
        return F.struct(c.alias("class"), F.lit(end).alias("end"), letters.alias("part"))

    members = F.array(*(member(c, end) for c in (size, size - 1) for end in (0, 1)))
    rows = words.select("word", "n", F.inline(F.filter(members, lambda m: m["class"] >= min_length)))
    keys = ["class", "end", "part"]
    large = rows.groupBy(*keys).count().filter(F.col("count") > tile)
    large = large.select(*(F.col(k).alias(f"_{k}") for k in keys), F.ceil(F.col("count") / tile).cast("int").alias("_tiles"))
    large = broadcast_if_small(large)
    joined = rows.join(large, [F.col(k) == F.col(f"_{k}") for k in keys], "left")
    tiles = F.coalesce("_tiles", F.lit(1))
    joined = joined.withColumn("_own", F.pmod(F.xxhash64("word"), tiles).cast("int"))
    # a tile meets itself and, as side 1 or 2, every other tile of its group
    pairs = F.transform(
        F.sequence(F.lit(0), tiles - 1),
        lambda t: F.struct(
            F.least(t, F.col("_own")).alias("low"),
            F.greatest(t, F.col("_own")).alias("high"),
            F.when(t == F.col("_own"), 0).when(t > F.col("_own"), 1).otherwise(2).alias("side"),
        ),
    )
    return joined.select(*keys, "word", "n", F.inline(pairs))


def _bits(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words, the first column in the lowest bit."""
    width = -(-rows.shape[1] // 64) * 64
    padded = np.zeros((rows.shape[0], width), bool)
    padded[:, : rows.shape[1]] = rows
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the letters (0: none), by word and position with one position more than the longest; lengths; how many numbers."""
    sizes = np.array([len(w) for w in words])
    found, flat = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), return_inverse=True)
    table = np.zeros((len(words), int(sizes.max()) + 2), np.int32)
    table[np.arange(table.shape[1]) < sizes[:, None]] = flat + 1
    return table, sizes, len(found) + 1


def near_on_shelf(words: list[str], group: np.ndarray, side: np.ndarray, c: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each word a bitset of its near words in its group that this group counts.

    `c` is the length of the shorter of the pairs in question, `end` is 1 where the group shares its words' ends.
    """
    table, sizes, letters = _letters(words)
    n = len(words)
    # the index: bitsets of the words by position and letter, made when a position comes near
    index: dict[int, np.ndarray] = {}

    def at(position: int) -> np.ndarray:
        if position not in index:
            column = table[:, position] if 0 <= position < table.shape[1] else np.zeros(n, np.int32)
            index[position] = _bits((column == np.arange(letters)[:, None]) & (column > 0))
            index.pop(position - 4, None)
        return index[position]

    of_length = {m: _bits((sizes == m)[None, :]) for m in np.unique(sizes).tolist()}
    width = at(0).shape[1]
    none = np.zeros((1, width), np.uint64)
    # whom a word may meet: its group, or the other tile of it
    own = group * 3 + side
    other = group * 3 + np.array([0, 2, 1])[side]
    names, place = np.unique(np.concatenate([own, other]), return_inverse=True)
    partners = _bits(place[:n] == np.arange(len(names))[:, None])[place[n:]]

    same = np.full((n, width), ~np.uint64(0))
    replaced, more, less = (np.zeros((n, width), np.uint64) for _ in range(3))
    result = np.zeros((n, width), np.uint64)
    half = c // 2
    for j in range(int(sizes.max()) + 1):
        done = np.flatnonzero(end.astype(bool) & (half == j))
        if len(done):  # these pairs are counted where the beginnings are equal
            partners[done] &= ~same[done]
        for m in np.unique(sizes[sizes == j]).tolist():
            short = np.flatnonzero((sizes == m) & (c == m))
            result[short] = (replaced[short] & of_length[m]) | ((more[short] | same[short]) & of_length.get(m + 1, none))
            long = np.flatnonzero((sizes == m) & (c < m))
            result[long] = less[long] & of_length.get(m - 1, none)
        if j == sizes.max():
            break
        read = table[:, j]
        here, after, before = at(j)[read], at(j + 1)[read], at(j - 1)[read]
        replaced = (replaced & here) | (same & ~here)
        more = (more | same) & after
        less = (less & before) | same
        same = same & here
    return result & partners


def _best(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bits each row has, and its lowest."""
    count = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    column = (bits != 0).argmax(axis=1)
    word = bits[np.arange(len(bits)), column]
    low = np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    return count, column * 64 + low


_KEYS = ("class", "end", "part", "low", "high")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, shelf: int = SHELF, tile: int = TILE) -> DataFrame:
    """`word`, `n_near`, `near` and `near_n` (the near word of the largest count, and the count) of words that have near words.

    `words` has distinct words in `word` and their counts in `n`.
    """
    rows = _groups(words, min_length, tile).select(*_KEYS, "side", "word", "n")
    rows = rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS)

    def found(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        columns = {name: table.column(name).to_pylist() for name in table.column_names}
        number: dict[tuple, int] = {}
        group = [number.setdefault(k, len(number)) for k in zip(*(columns[k] for k in _KEYS))]
        order = sorted(range(len(group)), key=lambda i: (-columns["n"][i], columns["word"][i]))
        ordered = [columns["word"][i] for i in order]
        arrays = (np.array([x[i] for i in order]) for x in (group, columns["side"], columns["class"], columns["end"]))
        count, best = _best(near_on_shelf(ordered, *arrays))
        some = np.flatnonzero(count).tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([ordered[i] for i in some], pa.string()),
                pa.array(count[some], pa.int64()),
                pa.array([ordered[best[i]] for i in some], pa.string()),
                pa.array([columns["n"][order[best[i]]] for i in some], pa.int64()),
            ],
            ["word", "n_near", "near", "near_n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = letters = 0
        last = None
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                if held:
                    yield found(held)
                break
            keys = list(zip(*(batch.column(k).to_pylist() for k in _KEYS)))
            start = 0
            for i, key in enumerate(keys):
                # a shelf ends with a group; one of long words has fewer
                if key != last and (size >= shelf or letters >= SHELF_LETTERS):
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield found(held)
                    held, start, size, letters = [], i, 0, 0
                last = key
                size += 1
                letters += key[0]
            if start < len(keys):
                held.append(batch.slice(start))

    near = rows.mapInArrow(run, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    merged = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return merged.select("word", "n_near", F.col("_best.near").alias("near"), (-F.col("_best.minus")).alias("near_n"))


def _stored(table: DataFrame, label: str) -> DataFrame:
    path = scratch_path(table.sparkSession, label)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


def roots(forms: DataFrame) -> DataFrame:
    """`word`, `root`: the last of the forms that begin with a word's `form`.

    Every round each word takes the root of its present root, so chains halve; counts grow along a chain, so there is an end.
    """
    now = _stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = now.join(onward, F.col("root") == F.col("_at"), "left")
        step = _stored(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if not step.filter("moved").limit(1).count():
            return now


def group_variants(words: DataFrame, factor: int = FORM_FACTOR, min_length: int = MIN_LENGTH, shelf: int = SHELF, tile: int = TILE) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` of all `words` (distinct `word`, count `n`).

    A word's form is its near word of the largest count, if that is at least `factor` times the word's own.
    """
    words = _stored(words.select("word", "n"), "words")
    near = near_words(words, min_length, shelf, tile).withColumnRenamed("word", "_word")
    joined = words.join(near, F.col("word") == F.col("_word"), "left")
    frequent = F.col("near_n") >= factor * F.col("n")
    judged = joined.select(
        "word",
        F.when(frequent, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("near_n")).alias("form_n"),
    )
    judged = _stored(judged, "forms")
    last = roots(judged.filter(F.col("form").isNotNull())).withColumnRenamed("word", "_word")
    known = judged.join(last, F.col("word") == F.col("_word"), "left")
    return known.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
