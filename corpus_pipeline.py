"""Documents to training tokens, in five stages; each stage's result is stored and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from windrow.llm import byte_bpe, decontaminate, quality, secrets, simhash
from windrow.llm.arrow import let_workers_import
from windrow.llm.queries import BYTE_RANKS, table
from windrow.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of SimHashes (4-word shingles, up to 4 differing bits) connect: that with the smallest id."""
    let_workers_import(spark)
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the spans of benchmark items, and without those that mostly consist of them."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def secret_masks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets masked."""
    return secrets.mask(docs)


def byte_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, encoded and decoded again."""
    let_workers_import(spark)
    return byte_bpe.round_trip_digests(docs, BYTE_RANKS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_masks", secret_masks),
    ("byte_tokens", byte_tokens),
]

#: SQL has no XXH64 and no byte-pair merging; a test compares the rows of every stage with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
