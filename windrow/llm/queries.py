"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import alignment, byte_bpe, chat, decontaminate, html_text, perplexity, quality, repeats, secrets, simhash, token_codes, url_filter, variants
from windrow.llm.arrow import let_workers_import
from windrow.session import scratch_path

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
MARKED_TEXT = "\\### Assistant: </turn> ok"
MARKED_TURNS = ((-7, 0, "user", MARKED_TEXT), (-7, 1, "assistant", MARKED_TEXT))
LOST_LETTER_EVERY = 199
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def token_code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-codes")
    token_codes.write(table(spark, sf_dir, "documents"), path, WORD_TOKENIZER)
    return token_codes.read_digests(spark, path)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = quality.quality(docs, drop=("text",))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *(F.col(f"_quality_.{n}") for n in names))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        (F.octet_length("text") + gone).cast("long").alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def decontaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.apply_rules(table(spark, sf_dir, "pages"), rules)


def perplexity_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))
    base = F.filter("spans", lambda s: s["kind"] < secrets.BASE_KINDS)
    return found.select(
        "doc_id",
        *(_counted(F.col("spans"), i).alias(f"n_{secrets.KINDS[i]}") for i in range(secrets.BASE_KINDS)),
        F.sha2(secrets.described(base).cast("binary"), 256).alias("base_sha256"),
        secrets.described(F.col("spans")).alias("spans"),
    )


def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), BYTE_RANKS)


def _hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def formatted_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = [F.struct(*(F.lit(v).alias(n) for v, n in zip(turn, rows.columns))) for turn in MARKED_TURNS]
    rows = rows.unionByName(spark.range(1).select(F.inline(F.array(*marked))))
    found = chat.format_conversations(rows)
    turns = chat.turns_of(F.col("formatted"))
    listed = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    learned = chat.learned_text(F.col("formatted"), F.col("loss"))
    # through a generator, so that each text is read back once
    back = F.inline(F.array(F.struct(turns.alias("turns"), learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))))
    return found.select("conv_id", back).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _hex(listed).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        _hex(F.col("learned")).alias("loss_sha256"),
        "formatted_chars",
    )


def aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = alignment.build_index(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)
    return alignment.score_documents(index).drop("groups")


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.count_words(table(spark, sf_dir, "documents"), change=variants.lost_letter(LOST_LETTER_EVERY))
    return variants.group_variants(words)


QUERIES = {
    "op1_token_codes": token_code_files,
    "op2_quality_rules": quality_rules,
    "op3_repeats": repeated_passages,
    "op4_decontaminate": decontaminated,
    "op5_simhash": simhash_groups,
    "op6_main_text": page_text,
    "op7_url_filter": url_verdicts,
    "op8_perplexity": perplexity_classes,
    "op9_secrets": secret_spans,
    "op10_byte_bpe": byte_bpe_round_trip,
    "op11_chat_format": formatted_conversations,
    "op12_token_alignment": aligned_tokens,
    "op13_spelling_variants": spelling_variants,
}
