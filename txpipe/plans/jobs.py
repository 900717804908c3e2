"""End-to-end batch jobs with the reference's entry points.

``transform_data`` is S1 -> W13 -> S4: read a date range of the daily table
(partition pruning), add flags and rolling features, write the feature table.
``save_dataset`` / ``load_dataset`` / ``get_tx_stats`` are the same
operations as :mod:`txpipe.sources.files` and :mod:`txpipe.operators.stats`
under the names users of the reference call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txpipe.operators.features import SkewConfig, build_features
from txpipe.operators.stats import daily_stats
from txpipe.sources import files as IO


def save_dataset(transactions: DataFrame, dir_output: str, start_date: str) -> None:
    """S3: one folder per day under ``dir_output``."""
    IO.save_daily(transactions, dir_output, start_date)


def load_dataset(spark: SparkSession, dir_input: str, begin_date: str, end_date: str) -> DataFrame:
    """Days ``begin_date .. end_date`` of the daily table."""
    return IO.load_dataset(spark, dir_input, begin_date, end_date)


def transform_data(
    spark: SparkSession,
    dir_input: str,
    dir_output: str,
    begin_date: str,
    end_date: str,
    history_days: int = 0,
    weekend_mode: str = "aligned",
    skew: SkewConfig | None = SkewConfig(),
) -> DataFrame:
    """W13 as a job: features of ``begin_date .. end_date`` written to
    ``dir_output``; returns the written table. ``history_days`` reads that
    many earlier days as window history (Q4; 0 = cold start, as the
    reference)."""
    lo = begin_date
    if history_days:
        from datetime import date, timedelta

        lo = (date.fromisoformat(begin_date) - timedelta(days=history_days)).isoformat()
    tx = IO.load_dataset(spark, dir_input, lo, end_date)
    feats = build_features(tx, weekend_mode, begin_date, end_date, history_days, skew=skew)
    IO.write_features(feats, dir_output)
    return IO.read_features(spark, dir_output)


def get_tx_stats(transactions: DataFrame, start_date_df: str = "2018-04-01") -> DataFrame:
    """A5 under the reference's name."""
    return daily_stats(transactions, start_date_df)
