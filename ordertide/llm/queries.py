"""The operators applied to whole tables with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm import (bpe, decontamination, html_text, line_dedup, lm, merkle, quality, quality_rules, search, simhash,
                           token_counts, toxicity, warc)
from ordertide.llm.common import fold, table
from ordertide.llm.training import labelled_sample


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return out.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumnRenamed("id", "doc_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


def fit_toxicity(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic",
                                        fold(F.col("doc_id"), 5) != 0, toxicity.PER_CLASS, toxicity.described, "string"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), fit_toxicity(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 5) == 0).alias("held_out"), "score", "predicted")


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = fold(F.col("doc_id"), 7)
    out = lm.lm_scores(table(spark, sf_dir, "documents"), remainder != 2, remainder == 5)
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 7) == 2).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumnRenamed("id", "doc_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", fold(F.col("doc_id"), 5) != 0,
                                        quality.PER_CLASS, quality.features, quality.FEATURES))
    out = quality.quality_scores(docs, model)
    return out.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 5) == 0).alias("held_out"), "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(fold(F.col("doc_id"), 5) == 0, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    given = merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), tampered)
    out = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], carry={"given": given})
    return (out.withColumn("folded_root", merkle.folded(F.col("given"), F.col("path")))
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract_text(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), "url", "text", "n_chars")


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_token_counts, op3_byte_bpe, op4_toxicity, op5_lm_scores, op6_quality_rules, op7_decontamination,
    op8_warc, op9_quality_classifier, op10_line_dedup, op11_merkle, op12_search, op13_html_text)}

ORACLES = {"op6_quality_rules": quality_rules.ORACLE_SQL, "op8_warc": warc.ORACLE_SQL,
           "op10_line_dedup": line_dedup.ORACLE_SQL, "op11_merkle": merkle.ORACLE_SQL, "op12_search": search.ORACLE_SQL}
