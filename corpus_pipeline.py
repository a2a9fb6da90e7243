"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillsight.llm import decontaminate, jaccard_join, packing, pii, toxicity
from tillsight.llm.common import scratch_path
from tillsight.llm.registry import BYTE_BPE, packed_digest, toxicity_model


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below 0.5, under a model learned from the labels of the training fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity_model(docs, labels))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles overlap by 0.8 or more."""
    return jaccard_join.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and lengths brought up to date."""
    return pii.mask_personal_data(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document as pieces of windows of 1024 tokens."""
    return packed_digest(packing.pack(docs, tokenizer=BYTE_BPE))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: learned scores, joins over components and tokenizers have no SQL form; the tests hold run() to a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
