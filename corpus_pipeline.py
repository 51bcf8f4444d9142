"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept, read from Parquet, and returns those that
go on, with the columns of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cascadia.llm import importance, near_documents, near_lines, packing, secret_scan
from cascadia.llm.common import documents, stored

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 1


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps; junk and toxic ones go."""
    return importance.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document or line has, but for a word's edit."""
    return near_lines.drop_near_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8."""
    return near_documents.drop_near_documents(docs, words=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret masked."""
    return secret_scan.redact_secrets(docs, RANKS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2,048 ids."""
    return packing.pack_documents(docs, VOCABULARY, END_ID)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("pack", pack),
]

#: Regular expressions aside, the stages rest on hashes, a fit and token ids that SQL lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written as Parquet and reread."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
