"""Documents to packed training sequences in five stages.

Every stage takes what the one before kept, as a Parquet table in the shared
checkpoint folder, and works on all of it:

1. toxicity         documents predicted toxic go
2. line_dedup       later lines that match an earlier one go (lines of 1 to 4 words: equal ones), and documents left without a word
3. near_dup         one document of each near-duplicate group stays (five-word shingles, similarity 0.8)
4. decontaminate    documents that hold a benchmark window go
5. packing          token pieces with their sequence and offset

The first four return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from manifestqc.llm import decontaminate, line_dedup, near_dup, packing, toxicity
from manifestqc.llm.common import table
from manifestqc.session import scratch_path


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs, min_words=1)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs, width=5, percent=80)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("near_dup", remove_near_duplicates),
    ("decontaminate", remove_contaminated),
    ("packing", pack),
]

# A learnt score, exact set similarity over all lines and a tokenizer are beyond SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
