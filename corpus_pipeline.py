"""A training corpus from raw documents, as a chain of stages.

Each stage takes what its predecessor kept, decides on all of it, and is written as
Parquet to the shared work folder before the next one reads it, so a lost executor costs
a part of one stage. All but the last return the columns they were given. Tables of earlier
stages are removed when the next one is written.

Rows are only dropped by a decision: documents whose language is not known, all but one
of a group whose fingerprints differ in at most three bits, and documents that hold
benchmark text. Secrets are replaced
inside the text. Empty tables pass through as empty ones; nulls are handled as the
operators say; further columns, of any name, are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclelens.llm import decontaminate, language_id, pieces, secrets_scan, simhash
from cyclelens.llm.batches import with_rows
from cyclelens.session import delete_folder, scratch, work_folder

MIN_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those whose language is unclear. Without a
    labelled document nothing can be learned, and all stay."""
    network = language_id.fit(docs.where(~language_id.held_out()))
    if network is None:
        return docs
    found = language_id.predict(with_rows(docs), network, "whole")
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return found.where(sure).select("row_id.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth of the words is benchmark text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(with_rows(docs), benchmark, "whole")
    return found.where(~decontaminate.is_contaminated()).select("row_id.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark; `n_chars` follows the text."""
    clean = secrets_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text, their number, and whether both libraries agree on them
    and decoding gives the text back. Columns of these names are replaced."""
    found = pieces.encode(with_rows(docs), pieces.read_model(), "whole", with_decoded=False)
    kept = [F.col(f"row_id.`{c}`") for c in docs.columns if c not in ("n_pieces", "ids", "round_trip", "parity")]
    return found.select(
        *kept, F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids", "round_trip", "parity"
    )


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("SentencePiece encoding", encoded),
]

# A trained network, fingerprint components and subword ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES):
        path = work_folder(spark, f"corpus-{number}")
        with scratch(spark):  # what the stage's operators wrote goes when its result is there
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        if before is not None:
            delete_folder(spark, before)
        docs, before = spark.read.schema(kept.schema).parquet(path), path
    return docs
