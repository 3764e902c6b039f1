"""Registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cyclelens.llm import (
    decontaminate,
    host_rules,
    language_id,
    phrases,
    pieces,
    quotes,
    secrets_scan,
    sharding,
    simhash,
    spelling,
    sql,
    subword_quality,
    suffixes,
    whitening,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SHARDS = 16


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.by_bytes(_table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select(
        F.col("row_id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        F.col("row_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept",
    )


def quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns hold no quotes, so they are first written as mails that quote."""
    mails = quotes.as_mails(_table(spark, sf_dir, "conversations"))
    return quotes.conversations(mails, "msg_id", "turn", "text", "conv_id").drop("sent")


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("row_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id",
    )


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        F.col("row_id").alias("doc_id"), "n_words", decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    network = language_id.fit(documents.where(~language_id.held_out()))
    found = language_id.predict(documents, network)
    return found.select(
        F.col("row_id").alias("doc_id"), language_id.held_out("row_id").alias("held_out"),
        "lang_pred", "score",
    )


def _removed():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed")


def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffixes.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select(
        F.col("row_id").alias("doc_id"), "n_bytes", _removed(),
        F.size("spans").cast("long").alias("n_spans"), "kept_sha256",
    )


def repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = phrases.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select(F.col("row_id").alias("doc_id"), "n_words", _removed(), "kept_sha256")


def sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode(_table(spark, sf_dir, "documents"), pieces.read_model())
    return encoded.select(
        F.col("row_id").alias("doc_id"), F.size("ids").cast("long").alias("n_pieces"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip", "parity",
    )


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.scan(_table(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")
        for rank, kind in enumerate(secrets_scan.KINDS[:3])
    ]
    return found.select(
        F.col("row_id").alias("doc_id"), *counts,
        F.sha2(secrets_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets_scan.span_text(F.col("spans")).alias("spans"),
    )


def spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return rows.select(
        F.col("row_id").alias("vec_id"), "n", "deviation", "identity_error", F.inline("components")
    )


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    learned = documents.where(~language_id.held_out())
    model = subword_quality.fit(learned, _table(spark, sf_dir, "labels"))
    return subword_quality.score(documents, model).select(
        F.col("row_id").alias("doc_id"), language_id.held_out("row_id").alias("held_out"), "score",
        (F.col("score") >= subword_quality.THRESHOLD).cast("int").alias("predicted"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_karmarkar_karp_shards": shards,
        "op2_host_quality_rules": quality,
        "op3_quotation_linking": quotations,
        "op4_benchmark_decontamination": decontamination,
        "op5_simhash_ball": near_copies,
        "op6_suffix_bucket_pointers": repeated_strings,
        "op7_sentencepiece": sentencepieces,
        "op8_phrase_automata": repeated_phrases,
        "op9_language_id": language,
        "op10_randomness_secret_scan": secrets,
        "op11_spelling_variants": spellings,
        "op12_embedding_whitening": whitened,
        "op13_quality_classifier": quality_scores,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_host_quality_rules": sql.HOST_RULES,
        "op3_quotation_linking": sql.QUOTATIONS,
        "op4_benchmark_decontamination": sql.DECONTAMINATION,
        "op6_suffix_bucket_pointers": sql.REPEATED_STRINGS,
        "op8_phrase_automata": sql.REPEATED_PHRASES,
        "op11_spelling_variants": sql.SPELLING,
    }
