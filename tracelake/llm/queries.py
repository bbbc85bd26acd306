"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import _shared, ann, bpe, decontam, html_extract, langid, linededup, merkle, neardup, packing, periodic, quality, tokenbin, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _labelled(spark: SparkSession, sf_dir: str, label: str, rows: int, ones_first: bool = False) -> DataFrame:
    """About ``rows`` documents to learn from: doc_id, text, label and stands (labelled rows for which it stands). They are chosen among the
    labels, which are narrow, so no text is moved: all alike, or those of label 1 up to half of ``rows`` first. Of several labels of one
    document the largest counts."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).cast("int").alias("label")).where("label in (0, 1) and doc_id is not null").where(_shared.crc_mod("doc_id", 5) != 0)
    labels = labels.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    take1 = min(n1, max(rows // 2, rows - n0)) if ones_first else rows * n1 / max(n1 + n0, 1)
    share1, share0 = (min(1.0, max(take, 1) / max(of, 1)) for take, of in ((take1, n1), (rows - take1, n0)))
    share = F.when(F.col("label") == 1, share1).otherwise(share0)
    chosen = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < share * (1 << 30)).withColumn("stands", 1 / share)
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # about ``rows`` ids at most


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(_shared.crc_mod("doc_id", 4) != 2))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", (_shared.crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "hit_rate")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_pages(pages, html_extract.fit(pages))


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.token_files(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = quality.fit(_labelled(spark, sf_dir, "quality", quality.FIT_ROWS), "label")
    scored = quality.score(table(spark, sf_dir, "documents").select("doc_id", "text"), weights)
    return scored.select("doc_id", (_shared.crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = toxicity.fit(_labelled(spark, sf_dir, "toxic", toxicity.COUNT_ROWS, ones_first=True), "label", stands_col="stands")
    tagged = toxicity.tag(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return tagged.select("doc_id", (_shared.crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic_spans")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_html_text, op3_nearest_vectors, op4_line_dedup, op5_minhash_dedup, op6_decontamination, op7_token_files, op8_quality, op9_word_bpe, op10_toxicity, op11_packing, op12_merkle_manifest, op13_periodic_runs)}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": linededup.ORACLE_SQL, "op5_minhash_dedup": neardup.ORACLE_SQL, "op6_decontamination": decontam.ORACLE_SQL, "op12_merkle_manifest": merkle.ORACLE_SQL}
