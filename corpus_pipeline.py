"""The corpus pipeline: each stage reads what the one before it wrote.

Toxic documents go, then exact copies, then near copies (one document of each class stays), then
documents contaminated by the benchmark; the rest is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codeloom.llm import decontaminate, exact_dedup, near_dedup, packing, registry, toxicity
from codeloom.session import scratch_path
from codeloom.sources.tables import read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicated(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, registry.word_bpe_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A trained classifier, sampling hashes and a tokenizer are no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("errorifexists").parquet(path)
        docs = spark.read.parquet(path)
    return docs
