"""Queries over written and re-read files.

Each writes to a fresh folder under the shared checkpoint folder, then
reads back with the library's readers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.operators.features import build_features
from txpipe.plans import oracle as O
from txpipe.plans.common import labelled
from txpipe.plans.registry import query
from txpipe.session import work_path
from txpipe.sources import files as IO
from txpipe.sources.fixture import ORIGIN_DATE
from txpipe.sources.messages import parse_messages, to_messages, write_messages

PL = O.labelled_prefix()
LAB = O.LAB_COLS


def _daily(spark, sf, as_text: bool = False) -> str:
    path = work_path(spark, "daily")
    IO.save_daily(labelled(spark, sf), path, ORIGIN_DATE, datetime_as_text=as_text)
    return path


@query(
    "s1_load_date_range",
    PL + f"SELECT {LAB} FROM lab WHERE CAST(TX_DATETIME AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'",
)
def s1(spark, sf):
    path = _daily(spark, sf)
    return IO.load_dataset(spark, path, "2024-01-08", "2024-01-21")


@query("s3_daily_files_roundtrip", PL + f"SELECT {LAB} FROM lab")
def s3(spark, sf):
    """Daily files with ``TX_DATETIME`` stored as text, read back whole."""
    path = _daily(spark, sf, as_text=True)
    return IO.load_dataset(spark, path)


@query("s2_read_one_day_file", PL + f"SELECT {LAB} FROM lab WHERE CAST(TX_DATETIME AS DATE) = DATE '2024-01-10'")
def s2(spark, sf):
    path = _daily(spark, sf)
    df = IO.read_file(spark, f"{path}/tx_date=2024-01-10")
    return df.withColumn("TX_DATETIME", F.col("TX_DATETIME").cast("timestamp"))


@query("u1_union_of_day_files", PL + f"SELECT {LAB} FROM lab")
def u1(spark, sf):
    """Every day's files, by three patterns of ten days, in one read."""
    path = _daily(spark, sf)
    return IO.union_files(spark, [f"{path}/tx_date=*-{tens}[0-9]" for tens in "0123"]).select(*[c.strip() for c in LAB.split(",")])


FEAT_SQL = O.with_(O.TX, O.PICKS, O.LAB, O.features_cte()) + f"SELECT {', '.join(S.FEATURE_TABLE)} FROM feat"


def _range_features_sql(lo: str, hi: str) -> str:
    src = f"(SELECT * FROM lab WHERE CAST(TX_DATETIME AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}')"
    return O.with_(O.TX, O.PICKS, O.LAB, O.features_cte(source=src)) + f"SELECT {', '.join(S.FEATURE_TABLE)} FROM feat"


@query("w13_transform_data_job", _range_features_sql("2024-01-05", "2024-01-25"))
def w13_job(spark, sf):
    """S3 -> S1 -> W13 -> S4 as one job over a date range (cold start)."""
    from txpipe.plans.jobs import save_dataset, transform_data

    daily = work_path(spark, "job-daily")
    save_dataset(labelled(spark, sf), daily, ORIGIN_DATE)
    return transform_data(spark, daily, work_path(spark, "job-features"), "2024-01-05", "2024-01-25")


@query("s4_feature_table_roundtrip", FEAT_SQL)
def s4(spark, sf):
    """Feature table written with the Parquet options, read back."""
    path = work_path(spark, "features")
    IO.write_features(build_features(labelled(spark, sf)), path)
    return IO.read_features(spark, path)


@query(
    "s9_json_messages_since",
    O.with_(O.TX, O.PICKS, O.LAB, O.features_cte())
    + f"SELECT {', '.join(S.FEATURE_TABLE)} FROM feat WHERE TX_DATETIME >= TIMESTAMP '2024-01-20 00:00:00'",
)
def s9(spark, sf):
    """S9/P14 then P6-P8: rows since a time as JSON text, parsed back."""
    feats = build_features(labelled(spark, sf))
    msgs = to_messages(feats, since="2024-01-20 00:00:00")
    path = work_path(spark, "messages")
    write_messages(msgs, path)
    good, _dead = parse_messages(spark.read.text(path))
    return good
