"""The corpus pipeline: documents go through the stages in turn, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinderlog.llm import decontaminate, packing, quality, secrets, similar
from cinderlog.llm.common import table
from cinderlog.session import work_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the trees, fitted on the labelled documents of the folder."""
    known = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.keep_good(docs, quality.train(known, table(spark, sf_dir, "labels", "doc_id", "quality")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents whose five-word shingles are similar by 0.8 or more."""
    return similar.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage makes up a twentieth of."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the secrets in their texts masked."""
    return secrets.redact(docs, secrets.update_ledger(docs, work_path(spark, "secret-ledger")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of the documents that are left."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the trees nor the fingerprints; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage makes of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
