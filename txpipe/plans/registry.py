"""Registry of named queries: ``key -> (spark, sf_dir) -> DataFrame``.

Each query reads the shared tables at ``sf_dir`` and runs the library's
operators over the whole tables. Timestamps leave as ``timestamp_ntz`` (the
type of the input) so results compare independent of the session zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Zone-aware timestamps -> zone-less (UTC wall time) for comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(key: str, sql: str | None = None):
    """Register ``fn`` under ``key``; ``sql`` is its DuckDB oracle (or None
    for the rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run

    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from txpipe.plans import (  # noqa: F401
        q_features,
        q_io,
        q_labels,
        q_metrics,
        q_model,
        q_scalar,
        q_spatial,
        q_stats,
        q_stream,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
