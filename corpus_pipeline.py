"""A training corpus from raw documents: five stages, each an operator of
``txpipe.llm``, each writing Parquet that the next one reads.

Edge cases: NULL, empty and blank texts have no words, so those that the
classifier keeps are one group of near-duplicates, of which the least doc_id
stays; repeated rows are such a group as well; a row without a doc_id is kept like
any other; a text that is NULL stays NULL until packing takes it as empty; texts
of any length pass whole; extra columns are carried up to the last stage, whatever
their names; an empty table gives an empty table at each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txpipe.llm import decontam, packing, quality, secrets, simhash
from txpipe.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind in brackets."""
    return secrets.redact(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences; the last stage."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", sequence_packing),
]

#: SQL can express neither the fitted classifier nor the fingerprints; tests
#: hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
