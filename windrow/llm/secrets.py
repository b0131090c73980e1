"""Secret scans over an incremental ledger of blobs, with DataFrame functions only.

A blob is a text under its SHA-256. The ledger, a Parquet folder, has a row of findings for every
blob and rule version that was ever scanned. A scan takes the distinct blobs of all versions given,
leaves out the pairs of blob and rule version that the ledger has, scans the rest, adds them, and joins the
findings back to every row (path, version) that holds the blob. Equal texts are combined before
they are shuffled, so a text with very many copies is scanned once.

Rules find the leftmost matches that do not overlap, each kind by itself; positions are code points,
the end exclusive. A match that fails its length test is dropped after it has taken its place. Kinds
are `assign`, `access` and `hex` (the base) and what `EXTRA_RULES` adds.

Null texts are empty and have no findings. Rows are kept one by one, whatever their ids. An empty
table gives an empty result. Only the columns named are read; helper columns begin with `_secret_`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.llm.columns import cut, running_maxima, running_sums
from windrow.llm.quality import let
from windrow.session import scratch_path

# fixed values: patterns of the base kinds, and what a match must have to stay
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# fixed values: published token formats and key blocks
EXTRA_RULES = (
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\\s]*-----END [A-Z ]*PRIVATE KEY-----"),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
)
KINDS = ("assign", "access", "hex", *(name for name, _ in EXTRA_RULES))
BASE_KINDS = 3
MIN_VALUE = 6
RULE_VERSION = 1
MASK = "[secret]"

_P = "_secret_"
SPAN = "array<struct<start:int,kind:int,stop:int>>"


def _spans(text: Column, kind: int, pattern: str, holds: Column | None = None, keep=None) -> Column:
    """Spans of one kind: the pieces between matches give the places, since Spark has no positions."""

    def placed(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        ends = let(gaps, lambda g: running_sums(F.transform(found, lambda m, i: F.length(F.get(g, i)) + F.length(m))))

        def span(m: Column, end: Column) -> Column:
            stop = end.cast("int")
            return F.struct((stop - F.length(m)).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), m.alias("m"))

        return let(ends, lambda e: F.transform(found, lambda m, i: span(m, F.get(e, i))))

    none = F.array().cast(SPAN)
    spans = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda f: F.when(F.size(f) > 0, placed(f)))
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s["m"]))
    plain = F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"]))
    sure = F.coalesce(plain, none)
    return sure if holds is None else F.when(holds, sure).otherwise(none)


def spans(text: Column) -> Column:
    """All spans of a text by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    base = [
        _spans(text, 0, ASSIGN, F.contains(text, F.lit(":")) | F.contains(text, F.lit("=")), keep=lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_VALUE),
        _spans(text, 1, ACCESS, F.contains(text, F.lit("AKIA"))),
        _spans(text, 2, HEX),
    ]
    marks = {"pem": "PRIVATE KEY", "github": "gh", "slack": "xox", "jwt": "eyJ"}
    extra = [
        _spans(text, BASE_KINDS + i, pattern, F.contains(text, F.lit(marks[name]))) for i, (name, pattern) in enumerate(EXTRA_RULES)
    ]
    return F.array_sort(F.concat(*base, *extra))


def ledger_schema() -> T.StructType:
    return T.StructType.fromDDL(f"blob binary, rules int, spans {SPAN}")


def blob(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


def update_ledger(versions: DataFrame, ledger: str, rules: int = RULE_VERSION, text: str = "text") -> DataFrame:
    """Scan what the ledger at `ledger` does not have yet, add it, and return the ledger's findings for `rules`, one row per blob.

    A lost task is run again before anything of the new part is visible; a job that is run again
    finds the pairs of finished parts and scans the others only. Two scans at the same time may both add a pair; their rows are
    equal, and readers take one. Blobs without findings are in the ledger, but not in what is returned.
    """
    spark = versions.sparkSession
    known = read_ledger(spark, ledger).filter(F.col("rules") == rules)
    blobs = versions.select(blob(F.col(text)).alias("blob"), F.col(text).alias("text"))
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    new = blobs.join(known.select("blob"), "blob", "left_anti")
    new.select("blob", F.lit(rules).alias("rules"), spans(F.col("text")).alias("spans")).write.mode("append").parquet(ledger)
    found = read_ledger(spark, ledger).filter((F.col("rules") == rules) & (F.size("spans") > 0))
    # the findings of one blob are equal, so the set has one
    return found.groupBy("blob").agg(F.get(F.collect_set("spans"), F.lit(0)).alias("spans"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; a new ledger is made with no rows."""
    spark.createDataFrame([], ledger_schema()).write.mode("append").parquet(ledger)
    return spark.read.schema(ledger_schema()).parquet(ledger)


def scan(versions: DataFrame, ledger: str, rules: int = RULE_VERSION, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `spans` of every version (row)."""
    found = update_ledger(versions, ledger, rules, text)
    rows = versions.select(key, blob(F.col(text)).alias(f"{_P}blob"))
    found = found.select(F.col("blob").alias(f"{_P}found"), "spans")
    joined = rows.join(found, F.col(f"{_P}blob") == F.col(f"{_P}found"), "left")
    return joined.select(key, F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def described(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark. `spans` are in order of their starts."""

    def gaps(spans: Column, reach: Column) -> Column:
        """What no span covers: before each run of overlapping spans, and behind the last. `reach`: the end of all spans so far."""
        first = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda i: (i == 0) | (F.get(spans, i)["start"] >= F.get(reach, i - 1)))
        before = F.transform(
            first,
            lambda i: F.struct(F.coalesce(F.get(reach, i - 1), F.lit(0)).alias("start"), F.get(spans, i)["start"].cast("long").alias("stop")),
        )
        last = F.struct(F.element_at(reach, -1).alias("start"), F.length(text).cast("long").alias("stop"))
        return F.concat(before, F.array(last))

    def built(spans: Column) -> Column:
        reach = running_maxima(F.transform(spans, lambda s: s["stop"]))
        return F.array_join(cut(text, let(reach, lambda r: gaps(spans, r))), MASK)

    return let(spans, lambda s: F.when(F.size(s) > 0, built(s)).otherwise(text))


def mask(
    docs: DataFrame, ledger: str | None = None, rules: int = RULE_VERSION, text: str = "text", n_chars: str = "n_chars"
) -> DataFrame:
    """`docs` with secrets masked; a column `n_chars`, if there is one, follows texts that change."""
    ledger = ledger or scratch_path(docs.sparkSession, "ledger")
    found = update_ledger(docs, ledger, rules, text)
    found = found.select(F.col("blob").alias(f"{_P}blob"), F.col("spans").alias(f"{_P}spans"))
    rows = docs.join(found, blob(F.col(text)) == F.col(f"{_P}blob"), "left")
    has = F.col(f"{_P}spans").isNotNull()
    rows = rows.withColumn(f"{_P}text", F.when(has, masked(F.col(text), F.col(f"{_P}spans"))).otherwise(F.col(text)))
    new = {text: F.col(f"{_P}text")}
    if n_chars in docs.columns:
        size = F.length(f"{_P}text").cast(docs.schema[n_chars].dataType)
        new[n_chars] = F.when(has, size).otherwise(F.col(n_chars))
    return rows.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
