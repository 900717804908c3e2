"""Shared inputs for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txpipe.operators.labels import label_frauds
from txpipe.operators.metrics import rule_prediction
from txpipe.sources.fixture import load_transactions


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_transactions(spark, sf_dir)


def labelled(spark: SparkSession, sf_dir: str, with_hits: bool = False) -> DataFrame:
    return label_frauds(load_transactions(spark, sf_dir), with_hits=with_hits)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled transactions with a fixed rule scorer's ``prediction``
    (amount before scenario 3 above 100), for oracle-checkable metrics."""
    tx = load_transactions(spark, sf_dir).withColumn("prediction", rule_prediction())
    return label_frauds(tx)
