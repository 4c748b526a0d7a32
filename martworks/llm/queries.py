"""Named queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.llm import (
    alignment, common, content_chunks, cover_tree, host_quality, language_id, line_blocks, merkle, mixing, near_duplicates,
    neural_lm, packing, pii, suffix_repeats,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(common.crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language_id.fit(docs, ~held_out)
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.judged(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "host_documents", "host_failures", "kept",
    )


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.extracted(_table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op5_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.linked(_table(spark, sf_dir, "embeddings"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "mix_block", "mix_slot", "mix_order"
    )


def op7_neural_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.coalesce(common.crc_mod(F.col("doc_id"), 7) != 2, F.lit(True))
    return neural_lm.scored(_table(spark, sf_dir, "documents"), learn).select(
        "doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(_table(spark, sf_dir, "documents")))


def op9_content_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_chunks.passages(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "end", "n_words", "first_doc_id", "first"
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def op12_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.repeats_removed(_table(spark, sf_dir, "documents")).drop("spans")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_host_quality": op2_host_quality,
    "op3_main_text": op3_main_text,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_cover_tree": op5_cover_tree,
    "op6_mixing": op6_mixing,
    "op7_neural_lm": op7_neural_lm,
    "op8_pii": op8_pii,
    "op9_content_chunks": op9_content_chunks,
    "op10_packing": op10_packing,
    "op11_merkle": op11_merkle,
    "op12_suffix_repeats": op12_suffix_repeats,
    "op13_alignment": op13_alignment,
}
