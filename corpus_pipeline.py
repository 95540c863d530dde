"""A training corpus from raw documents, in stages.

Each stage takes (spark, documents, folder of tables) and returns documents;
its result is written to the shared folder and read again by the next one, so a
lost executor costs at most a part of one stage. The last stage returns token
ids instead of texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapakdw.llm import bpe, decontam, langid, ordminhash, secret_scan
from lapakdw.llm.queries import VOCABULARY, table
from lapakdw.llm.shipping import importable
from lapakdw.llm.text import free_name
from lapakdw.runtime import clear_scratch, materialize, scratch_paths


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; texts without a letter and uncertain ones go."""
    importable(spark)
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the smallest id; of equal rows of it, one.

    Documents without words, null texts among them, all stay, with all columns. No rows give none.
    """
    importable(spark)
    return ordminhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages do not contaminate, with all columns; null and empty texts stay.

    Repeated rows are judged each. No rows, or no benchmark, drop none.
    """
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; texts without any stay as they are, null ones too.

    Columns of any name are kept; repeated rows are redacted each. No rows give none.
    """
    importable(spark)
    spans, clean = free_name(docs, "spans_found"), free_name(docs, "text_clean")
    found = secret_scan.find_secrets(docs, VOCABULARY, name=spans)
    found = found.withColumn(clean, secret_scan.redact(found["text"], found[spans]))
    size = F.when(F.size(spans) > 0, F.char_length(clean).cast("long")).otherwise(F.col("n_chars"))
    changed = {"text": F.col(clean).alias("text"), "n_chars": size.alias("n_chars")}
    return found.select(*(changed.get(c, F.col(c)) for c in docs.columns))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; ``round_trip`` tells that decoding them gives back the text.

    Encoding and decoding run in one task, over one vocabulary. A null text is
    the empty one; repeated rows stay; columns other than id, language and
    source go.
    """
    importable(spark)
    coded = bpe.encode(docs, VOCABULARY, keep=["doc_id", "lang", "source"], verify="round_trip")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        "piece_chars",
        "piece_tokens",
        "round_trip",
    )


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("byte_bpe", byte_bpe),
]

# Training a model and connecting near duplicates are beyond SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. What a stage has stored goes when the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), scratch_paths(spark)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        clear_scratch(spark, keep=[*before, scratch_paths(spark)[-1]])  # the last one is the table just written
    return docs
