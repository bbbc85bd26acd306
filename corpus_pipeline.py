"""A training corpus from raw documents: language ID, line dedup, near-dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next stage's docs. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import _shared, bpe, decontam, langid, linededup, neardup
from tracelake.llm.queries import table, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if this share of its n-grams (false positives taken out) is in some language's filter.
MIN_HIT_RATE = 0.3


def _columns(docs: DataFrame, text_changed: bool = False) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.select(*[F.length("text").cast("long").alias(c) if text_changed and c == "n_chars" else c for c in COLUMNS])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without letters and those that fit no language go. A missing lang is filled in. Where no
    document has a lang there is nothing to hold documents against, and all stay."""
    model = langid.fit(docs)
    if not model.langs:
        return _columns(docs)
    kept = langid.predict(docs, model).where((F.col("lang_pred") != "und") & (F.col("hit_rate") >= MIN_HIT_RATE))
    return _columns(kept.withColumn("lang", F.coalesce("lang", "lang_pred")))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; so do documents of which nothing is left."""
    cut = linededup.dedup_lines(docs)
    return _columns(cut.where((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0)), text_changed=True)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id."""
    kept = neardup.near_duplicates(docs).where("kept").select("doc_id").distinct()
    return _columns(docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi"))


def remove_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside an occurrence of a benchmark window are cut from the texts; all documents stay."""
    return _columns(decontam.remove_contamination(docs, table(spark, sf_dir, "benchmark")), text_changed=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each text."""
    return bpe.token_digests(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("MinHash near-dedup", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark_text),
    ("BPE encoding and decoding", encode),
]

#: The stages fit a model and call a tokenizer, which SQL can't; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = _shared.settle(docs, name.replace(" ", "-"))
    return docs
