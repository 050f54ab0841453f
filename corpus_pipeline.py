"""The corpus pipeline: documents through the corpus operators, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm.common import table
from tillroll.llm.decontam import without_copies
from tillroll.llm.jaccard import one_of_each
from tillroll.llm.packing import pack_documents
from tillroll.llm.secret_scan import without_secrets
from tillroll.llm.toxicity import without_toxic
from tillroll.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at 0.8 of five-word shingles."""
    return one_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return without_copies(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked and n_chars renewed."""
    clean = without_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    # Workers still hold what the stages before took; time is no matter here.
    return pack_documents(docs, width=2048, end_id=0, remembered=250_000)


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: No SQL expresses a trained classifier or an alignment; run() and each stage
#: are held against plain versions in tests/llm/test_pipeline_and_kernel.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents, each stage's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        kept = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
