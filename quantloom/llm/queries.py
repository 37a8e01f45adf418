"""The queries opN_<name>: each applies its operator, with production parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_formatting,
    conversation_repair,
    decontamination,
    hard_negatives,
    jaccard_join,
    line_dedup,
    quality_rules,
    sentencepiece_codec,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    token_files,
    url_filters,
)
from .common import read, work_path
from .oracles import ORACLES


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_windows(read(spark, sf_dir, "documents"), with_text=False)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_bytes(read(spark, sf_dir, "documents"), with_text=False)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    token_files.write_token_files(read(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_token_files(spark, path, with_ids=False)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated_words(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    items = F.sort_array(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.transform(h["items"], lambda i: i.cast("string"))))))
    n_hit = decontamination.covered(F.col("hits"))
    return found.select(F.col("__id").alias("doc_id"), F.size("words").cast("long").alias("n_words"), n_hit.alias("n_hit"), items.alias("ids")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = spark.sql(
        "SELECT -1L AS conv_id, CAST(t AS BIGINT) AS turn, IF(t = 0, 'user', 'assistant') AS role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0), (1) AS v(t)"
    )
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hard)
    back = chat_formatting.read_chats(chat_formatting.format_chats(given))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), every.alias("every"), F.array_join("loss_texts", "").alias("loss"), "formatted").select(
        "conv_id",
        "n_turns",
        F.sha2("every", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.write_ledger(read(spark, sf_dir, "documents"), work_path(spark, "ledger"), lang_col="lang")
    base = quality_rules.mask(quality_rules.BASE)
    return quality_rules.apply_policy(book, quality_rules.POLICIES[quality_rules.CURRENT]).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failed_bits").bitwiseAND(F.lit(base).cast("long")) != 0).alias("base_failed"),
        "kept",
        "failed_bits",
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.ablations(quality_rules.write_ledger(read(spark, sf_dir, "documents"), work_path(spark, "ledger"), lang_col="lang"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(read(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.size("__removed").cast("long").alias("n_removed"),
        F.array_join("__removed", ",").alias("removed_lines"),
        F.sha2(F.coalesce("__kept", F.lit("")), 256).alias("kept_sha256"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations")
    found = conversation_repair.repair_digests(conversation_repair.damage(given))
    every = given.select(F.col("conv_id").cast("long").alias("every")).distinct()
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return every.join(found, F.col("every").eqNullSafe(found["conv_id"]), "left").select(
        F.col("every").alias("conv_id"),
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", label))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def queries() -> dict:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_simhash_dedup": op3_simhash_dedup,
        "op4_token_files": op4_token_files,
        "op5_decontamination": op5_decontamination,
        "op6_chat_formatting": op6_chat_formatting,
        "op7_quality_rules": op7_quality_rules,
        "quality_ablations": quality_ablations,
        "op8_sentencepiece": op8_sentencepiece,
        "op9_url_filters": op9_url_filters,
        "op10_line_dedup": op10_line_dedup,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_jaccard_join": op13_jaccard_join,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
