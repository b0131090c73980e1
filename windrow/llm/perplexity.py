"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model of a language is made of strings of `ORDER` bytes. Trusted documents are those that the labels
call good; nine tenths of them (by a hash of the id) train, the rest calibrate. Counting, discounts and
the tables of every order are Spark aggregations over (language, string). Their rows are counted: up
to `broadcast_rows` of them go to every executor; beyond that, each block of documents asks once for
every string it holds, and joins give the probabilities, the same ones. A document is kept if its perplexity is at most the `quantile` of its language's calibration
documents. A language with fewer than `min_calibration` of them takes the quantile of all languages together; without
any, and for texts shorter than `min_bytes`, the verdict is to keep. A string the model of the language does not know backs off to
shorter ones, at last to a uniform byte.

Texts: null is empty, and an empty text has a null perplexity. A null language is one of its own. Repeated rows and
ids each give a row; if an id has several labels, one good label makes it trusted. Null ids are never trusted. Empty tables give empty
results. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm import exchange
from windrow.llm.arrow import chunks, text_bytes
from windrow.operators.small_side import broadcast_if_small
from windrow.session import scratch_path

ORDER = 4
START = b"\x02"
BROADCAST_ROWS = 1 << 21  # of a key and a number, 16 bytes


@dataclass(frozen=True)
class Limits:
    quantile: float = 0.99
    min_calibration: int = 20
    min_bytes: int = 100


def grams(text: bytes) -> np.ndarray:
    """The string of ORDER bytes that ends at each byte of a text, as a number; the text's last byte is the lowest."""
    data = np.frombuffer(START * (ORDER - 1) + text, np.uint8).astype(np.int64)
    n = len(text)
    out = np.zeros(n, np.int64)
    for k in range(ORDER):
        out = out << 8 | data[k : k + n]
    return out


def _batch_rows(batch: pa.RecordBatch) -> list[tuple[object, str, bytes]]:
    return list(zip(batch.column("id").to_pylist(), batch.column("lang").to_pylist(), text_bytes(batch.column("text"))))


def _block_rows(row: dict) -> list[tuple[object, str, bytes]]:
    return _batch_rows(exchange.from_bytes(row["payload"]))


def _by_language(rows: list[tuple[object, str, bytes]]) -> dict[str, list[bytes]]:
    texts: dict[str, list[bytes]] = {}
    for _, lang, text in rows:
        texts.setdefault(lang, []).append(text)
    return texts


def _counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings of all texts and their counts, a few megabytes of text at a time."""
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    lot, size = [], 0
    for i, text in enumerate(texts):
        lot.append(grams(text))
        size += len(text)
        if size > 1 << 22 or i + 1 == len(texts):
            new, n = np.unique(np.concatenate(lot), return_counts=True)
            every, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
            keys, counts = every, np.bincount(inverse, np.concatenate([counts, n]), len(every)).astype(np.int64)
            lot, size = [], 0
    return keys, counts


def _each_block(blocks: DataFrame, body, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from body({name: batch.column(name)[i].as_py() for name in batch.schema.names})

    return blocks.mapInArrow(run, schema)


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of all texts and their counts, combined over a few batches."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, texts in held.items():
            keys, counts = _counted(texts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], ["lang", "gram", "n"])

    for batch in batches:
        for part, texts in chunks(batch, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), texts):
                held.setdefault(lang, []).append(text)
                size += len(text)
            if size > exchange.BLOCK_BYTES:
                yield from counted()
                held, size = {}, 0
    yield from counted()


def _wanted(row: dict) -> Iterator[pa.RecordBatch]:
    for lang, texts in _by_language(_block_rows(row)).items():
        keys, _ = _counted(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["block"]] * len(keys), pa.int64()), pa.array([lang] * len(keys)), pa.array(keys)], ["block", "lang", "gram"]
        )


def _stored(table: DataFrame, label: str) -> DataFrame:
    path = scratch_path(table.sparkSession, label)
    table.write.parquet(path)
    return table.sparkSession.read.parquet(path)


def _discounted(n: Column, d: Column) -> Column:
    return F.greatest(n - F.get(d, F.least(n, F.lit(3)).cast("int") - 1), F.lit(0.0))


def model(counts: DataFrame) -> list[DataFrame]:
    """For each order from ORDER down to 1 a table (lang, gram, share) and one of contexts (lang, context, weight).

    `share` is the discounted part of a string's probability, `weight` what its context leaves to
    the next shorter one. Lower orders count the distinct bytes that a string follows.
    """
    tables, now = [], counts
    for order in range(ORDER, 0, -1):
        low = (1 << 8 * order) - 1
        if order < ORDER:
            now = now.groupBy("lang", F.col("gram").bitwiseAND(F.lit(low)).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        now = _stored(now, f"order{order}")
        n = F.col("n")
        seen = [F.count(F.when(n == k, 1)) for k in (1, 2, 3, 4)]
        of = now.groupBy("lang").agg(*(s.cast("double").alias(f"n{k}") for k, s in enumerate(seen, 1)))
        # null where nothing was seen: a condition before a division does not keep it from being worked out
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

        def discount(k: int) -> Column:
            made = k - F.try_divide((k + 1) * y * F.col(f"n{k + 1}"), F.col(f"n{k}"))
            # too few strings to tell: the middle of what is possible
            return F.when((F.col("n1") > 0) & made.between(0, k), made).otherwise(F.lit(k / 2))

        of = of.select(F.col("lang").alias("of"), F.array(*(discount(k) for k in (1, 2, 3))).alias("d"))
        whole = now.join(F.broadcast(of) if _few(of) else of, F.col("lang") == F.col("of"))
        context = F.shiftright("gram", 8).alias("context")
        taken = F.sum(n - _discounted(n, F.col("d")))
        contexts = whole.groupBy("lang", context).agg(F.sum("n").alias("total"), (taken / F.sum("n")).alias("weight"))
        contexts = _stored(contexts, f"contexts{order}")
        shares = whole.withColumn("context", F.shiftright("gram", 8)).join(contexts, ["lang", "context"])
        shares = shares.select("lang", "gram", (_discounted(n, F.col("d")) / F.col("total")).alias("share"))
        tables += [shares, contexts.select("lang", "context", "weight")]
    return tables


def _few(table: DataFrame) -> bool:
    return table.limit(1001).count() <= 1000


def probabilities(strings: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """`lang`, `gram` and `logp` of distinct strings: interpolated from the longest order to a uniform byte."""
    rows = strings.select("lang", "gram")
    p, left = F.lit(0.0), F.lit(1.0)
    for k, order in enumerate(range(ORDER, 0, -1)):
        low = (1 << 8 * order) - 1
        shares, contexts = tables[2 * k], tables[2 * k + 1]
        shares = shares.select("lang", F.col("gram").alias("_cut"), F.col("share").alias(f"s{order}"))
        contexts = contexts.select("lang", F.col("context").alias("_context"), F.col("weight").alias(f"w{order}"))
        rows = rows.withColumn("_cut", F.col("gram").bitwiseAND(F.lit(low))).withColumn("_context", F.shiftright("_cut", 8))
        rows = rows.join(shares, ["lang", "_cut"], "left").join(contexts, ["lang", "_context"], "left").drop("_cut", "_context")
        p = p + left * F.coalesce(F.col(f"s{order}"), F.lit(0.0))
        left = left * F.coalesce(F.col(f"w{order}"), F.lit(1.0))
    return rows.select("lang", "gram", F.log(p + left / 256).alias("logp"))


def _looked_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray], default: float) -> np.ndarray:
    known, values = table
    if not len(known):
        return np.full(len(keys), default)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], default)


def interpolated(keys: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """What `probabilities` gives, from the sorted tables of one language."""
    p, left = np.zeros(len(keys)), np.ones(len(keys))
    for k, order in enumerate(range(ORDER, 0, -1)):
        cut = keys & ((1 << 8 * order) - 1)
        p += left * _looked_up(cut, tables[2 * k], 0.0)
        left *= _looked_up(cut >> 8, tables[2 * k + 1], 1.0)
    return np.log(p + left / 256)


def _gathered(tables: list[DataFrame]) -> dict[str, list[tuple[np.ndarray, np.ndarray]]]:
    """For each language its sorted tables; only for tables whose rows have been counted."""
    found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    nothing = np.empty(0, np.int64), np.empty(0)
    for k, table in enumerate(tables):
        rows = table.toArrow()
        langs = rows.column(0).combine_chunks().dictionary_encode()
        codes, keys, values = langs.indices.to_numpy(), rows.column(1).to_numpy(), rows.column(2).to_numpy()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            mine = np.flatnonzero(codes == code)
            mine = mine[np.argsort(keys[mine])]
            found.setdefault(lang, [nothing] * len(tables))[k] = keys[mine], values[mine]
    return found


def _scored(rows: list[tuple[object, str, bytes]], known: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """`known` has for every language the sorted strings of the rows and their logarithms."""
    ids, langs, sizes, scores = [], [], [], []
    for key, lang, text in rows:
        ids.append(key)
        langs.append(lang)
        sizes.append(len(text))
        if text:
            keys, values = known[lang]
            scores.append(float(np.exp(-values[np.searchsorted(keys, grams(text))].mean())))
        else:
            scores.append(None)
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(sizes, pa.int64()), pa.array(scores, pa.float64())],
        ["id", "lang", "n_bytes", "perplexity"],
    )


SCORED = "id long, lang string, n_bytes long, perplexity double"


def _scored_by_broadcast(rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(_gathered(tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unknown = [(np.empty(0, np.int64), np.empty(0))] * 2 * ORDER
        for batch in batches:
            for part, _ in chunks(batch, "text"):
                texts = _batch_rows(part)
                known = {}
                for lang, mine in _by_language(texts).items():
                    keys, _ = _counted(mine)
                    known[lang] = keys, interpolated(keys, shared.value.get(lang, unknown))
                yield from _scored(texts, known)

    return rows.mapInArrow(run, SCORED)


def _scored_by_joins(rows: DataFrame, tables: list[DataFrame]) -> DataFrame:
    blocks = exchange.pack(rows, "documents")
    wanted = _stored(_each_block(blocks, _wanted, "block long, lang string, gram long"), "wanted")
    logs = _stored(probabilities(wanted.select("lang", "gram").distinct(), tables), "logs")
    packed = wanted.join(logs, ["lang", "gram"]).groupBy("block", "lang").agg(F.collect_list(F.struct("gram", "logp")).alias("p"))
    packed = packed.groupBy("block").agg(F.collect_list(F.struct("lang", F.col("p.gram").alias("grams"), F.col("p.logp").alias("logs"))).alias("model"))

    def run(row: dict) -> Iterator[pa.RecordBatch]:
        known = {}
        for part in row["model"] or []:
            keys, values = np.array(part["grams"], np.int64), np.array(part["logs"], np.float64)
            order = np.argsort(keys)
            known[part["lang"]] = keys[order], values[order]
        return _scored(_block_rows(row), known)

    return _each_block(blocks.join(packed, "block", "left"), run, SCORED)


def score(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """`id`, `lang`, `n_bytes`, `perplexity`, `calibrates` of every document. `trusted` has distinct ids in `id`."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("text"))
    trusted = trusted.select("id", (F.pmod(F.xxhash64("id"), F.lit(10)) == 0).alias("calibrates"))
    trained = rows.join(broadcast_if_small(trusted.filter(~F.col("calibrates")).select("id")), "id")
    counts = trained.mapInArrow(_training, "lang string, gram long, n long")
    tables = model(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))

    n_rows = sum(table.count() for table in tables)
    scored = (_scored_by_broadcast if n_rows <= broadcast_rows else _scored_by_joins)(rows, tables)
    scored = _stored(scored, "scored")
    return scored.join(trusted.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").select(
        "id", "lang", "n_bytes", "perplexity", F.coalesce("calibrates", F.lit(False)).alias("calibrates")
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    limits: Limits = Limits(),
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    quality: str = "quality",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """`key`, `n_bytes`, `perplexity`, `limit` (null: none could be set) and `kept` of every document."""
    trusted = labels.filter((F.col(quality) == 1) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id")).distinct()
    scored = _stored(score(docs, trusted, key, text, lang, broadcast_rows), "perplexities")
    judged = scored.filter("calibrates").filter(F.col("n_bytes") >= limits.min_bytes)
    quantile = F.percentile_approx("perplexity", F.lit(limits.quantile), F.lit(10000))
    overall = judged.agg(quantile.alias("q")).first()["q"]
    own = judged.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n"), quantile.alias("own"))
    own = broadcast_if_small(own.filter(F.col("n") >= limits.min_calibration).select("of", "own"))
    rows = scored.join(own, F.col("lang") == F.col("of"), "left")
    limit = F.coalesce(F.col("own"), F.lit(overall).cast("double"))
    kept = (F.col("n_bytes") < limits.min_bytes) | F.coalesce(F.col("perplexity") <= limit, F.lit(True))
    return rows.select(F.col("id").alias(key), "n_bytes", "perplexity", limit.alias("limit"), kept.alias("kept"))
