"""A corpus pipeline of five stages over ``documents``.

Each stage works on all that its predecessor kept and was written as Parquet.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ordertide.llm import bpe, decontamination, line_dedup, queries, simhash, toxicity  # noqa: E402
from ordertide.llm.common import table, written  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    scored = toxicity.toxicity_scores(docs, queries.fit_toxicity(spark, sf_dir), keep_columns=True)
    return scored.where("toxic_predicted = 0").select(*docs.columns)


def strip_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the lines that line dedup drops."""
    return line_dedup.line_dedup(docs).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, that of the smallest id; every row is judged by
    its own text, and rows with a null id belong to no group and stay."""
    return simhash.one_of_each_group(docs, shingle=4, bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, whether document or item has an id or not."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document: doc_id, n_tokens, and digests of its ids and decoded bytes."""
    import public_tokenizers
    out = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", strip_repeated_lines),
    ("simhash", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]

#: Model, edit distance and token stages can't be stated in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
