"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. quality         rows that the classifier scores below 0.5 go (operator 8)
2. exact_dedup     one row of each group of equal texts stays (operator 2)
3. near_dedup      one row of each component of near copies stays: five-word shingles, similarity 0.8
                   (operator 1; the similarity that near-duplicate stages take without a contract of
                   their own)
4. decontaminate   rows that hold passages of the benchmark go (operator 9)
5. encode          the rows that are left, with token ids (operator 6)

All stages but the last return the columns of ``documents``. Each judges what its predecessor
kept; nulls, empty tables and repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.llm import bpe, decontaminate, exact_dedup, jaccard, quality
from cellmart.llm.queries import tokenizer_file
from cellmart.llm.tables import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))
    return rows.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("encode", encode),
]

# The classifier's scores and the token ids have no SQL; tests/llm/test_pipeline.py holds the
# stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
