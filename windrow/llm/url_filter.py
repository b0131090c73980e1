"""URL filters by a sort-merge range join.

A host is turned round, label by label, each label closed by U+0001; then a rule's host and all its
subdomains are one interval of the sorted keys, and intervals of rules are nested or apart. URLs are
range-partitioned and sorted by key once; in every partition a sweep over URLs and rules keeps the
stack of rule hosts whose interval is open. Of the rules on the stack, the longest whose path begins
the URL's path decides: most characters of host and path together, then the longer host; of equal
rules that differ in their verdict, block.

Rules go to the executors in lots of at most `shard_rows`; with several lots the sorted URLs pass
through one sweep after another. Rules with a null in them are ignored.

A URL that is null or has no `://` has an empty host and path, and no rule fits it unless a rule has an empty
host. A host with very many URLs is split by a hash of the row. Repeated rows stay; an empty table gives an
empty result. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD_ROWS = 1 << 17
DEFAULT_VERDICT = "allow"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def canonical(host: Column) -> Column:
    """Labels from the last to the first, each closed by U+0001."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "\u0001"), F.lit("\u0001"))


def _key(host: str) -> str:
    return "".join(f"{label}\u0001" for label in reversed(host.split(".")))


class Sweep:
    """Best rule for URLs that come in the order of their keys."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        by_key: dict[bytes, list[tuple[str, str, str]]] = {}
        for rule in rules:
            by_key.setdefault(_key(rule[0]).encode(), []).append(rule)
        self.nodes = sorted(by_key.items())
        self.next = 0
        self.open: list[tuple[bytes, list[tuple[str, str, str]]]] = []

    def best(self, key: bytes, path: str) -> tuple[int, int, str, str] | None:
        """Length, length of the host, the rule and its verdict."""
        while self.open and not key.startswith(self.open[-1][0]):
            self.open.pop()
        while self.next < len(self.nodes) and self.nodes[self.next][0] <= key:
            node = self.nodes[self.next]
            self.next += 1
            if key.startswith(node[0]):
                self.open.append(node)
        fits = (
            (len(host) + len(start), len(host), host + start, verdict)
            for _, rules in self.open
            for host, start, verdict in rules
            if path.startswith(start)
        )
        return max(fits, key=lambda f: (f[0], f[1], f[3] == "block", f[2]), default=None)


def apply_rules(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = DEFAULT_VERDICT,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """`key`, `host`, `path`, `rule` (null if none fits) and `verdict`. `rules`: host, path, verdict."""
    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("place", F.encode(canonical(F.col("host")), "UTF-8")).withColumn("salt", F.xxhash64(key, "path"))
    rows = rows.repartitionByRange("place", "salt").sortWithinPartitions("place")
    found = rows.select(key, "host", "path", "place", F.lit(0).alias("size"), F.lit(0).alias("host_size"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    for lot in _lots(rules, shard_rows):
        found = _swept(found, lot, key, kind)
    return found.select(key, "host", "path", "rule", "verdict")


def _lots(rules: DataFrame, shard_rows: int) -> Iterator[list[tuple[str, str, str]]]:
    lot: list[tuple[str, str, str]] = []
    for row in rules.select("host", "path", "verdict").dropna().toLocalIterator():
        lot.append(tuple(row))
        if len(lot) >= shard_rows:
            yield lot
            lot = []
    if lot:
        yield lot


def _swept(found: DataFrame, lot: list[tuple[str, str, str]], key: str, kind: str) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(lot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep(shared.value)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("place", "path", "size", "host_size", "rule", "verdict")]
            out = []
            for place, path, size, host_size, rule, verdict in zip(*columns):
                best = sweep.best(place, path)
                known = (size, host_size, rule, verdict)
                if best is not None and (rule is None or (best[0], best[1], best[3] == "block", best[2]) > (size, host_size, verdict == "block", rule)):
                    known = best
                out.append(known)
            types = (pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (key, "host", "path", "place")), *(pa.array([r[i] for r in out], t) for i, t in enumerate(types))],
                [key, "host", "path", "place", "size", "host_size", "rule", "verdict"],
            )

    schema = f"`{key}` {kind}, host string, path string, place binary, size int, host_size int, rule string, verdict string"
    return found.mapInArrow(run, schema)
