"""Scalar column expressions: casts, calendar flags, offsets, formats.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txpipe import schema as S

__all__ = [
    "to_timestamp_col",
    "replace_missing_marker",
    "night_flag",
    "weekend_flag",
    "fill_numeric_nulls",
    "seconds_since",
    "days_since",
    "timestamp_from_offset",
    "date_from_offset",
    "format_datetime",
    "distance",
    "wrong_prediction",
    "rounded_ratio",
]

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def to_timestamp_col(c: str | Column) -> Column:
    """Text or zone-less timestamp to ``timestamp`` (session zone)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("timestamp") if hasattr(c, "try_cast") else c.cast("timestamp")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def replace_missing_marker(df: DataFrame, columns: list[str] | None = None, marker: int = -1) -> DataFrame:
    """The missing marker ``-1`` becomes 0 in every numeric column
    (or in ``columns``); strings are untouched."""
    cols = set(columns if columns is not None else numeric_columns(df))
    out = []
    for f in df.schema.fields:
        if f.name in cols and isinstance(f.dataType, _NUMERIC):
            c = F.col(f.name)
            out.append(F.when(c == F.lit(marker), F.lit(0).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def night_flag(ts: str | Column = "TX_DATETIME") -> Column:
    """1 from 00:00:00 to 06:59:59, else 0 (NULL time gives 0)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.when(F.hour(ts) <= S.NIGHT_LAST_HOUR, 1).otherwise(0)


def weekend_flag(ts: str | Column = "TX_DATETIME", mode: str = "aligned") -> Column:
    """``aligned`` matches the reference's day-within-7-day-block of the
    month (days 5-7, 12-14, 19-21, 26-28); ``calendar`` is Saturday/Sunday."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    if mode == "aligned":
        aligned = (F.dayofmonth(ts) - 1) % 7 + 1
        return F.when(aligned >= S.WEEKEND_FIRST_ALIGNED_DAY, 1).otherwise(0)
    if mode == "calendar":
        return F.when(F.weekday(ts) >= 5, 1).otherwise(0)
    raise ValueError(f"unknown weekend mode {mode!r}")


def fill_numeric_nulls(df: DataFrame, value: int = 0) -> DataFrame:
    """P5: NULL to 0 in numeric columns."""
    return df.fillna(value)


def seconds_since(ts: str | Column, origin: str) -> Column:
    """Whole seconds from ``origin`` (floor)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor((F.unix_micros(ts) - F.unix_micros(F.lit(origin).cast("timestamp"))) / F.lit(1_000_000)).cast("bigint")


def days_since(ts: str | Column, origin: str) -> Column:
    """Calendar days from ``origin`` (date difference)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.datediff(F.to_date(ts), F.lit(origin).cast("date")).cast("bigint")


def timestamp_from_offset(seconds: str | Column, origin: str) -> Column:
    """``origin + seconds``."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.lit(origin).cast("timestamp") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def date_from_offset(days: str | Column, origin: str) -> Column:
    """``origin + days`` as a date."""
    days = F.col(days) if isinstance(days, str) else days
    return F.date_add(F.lit(origin).cast("date"), days.cast("int"))


def format_datetime(ts: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Timestamp to text."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, fmt)


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Euclidean distance."""
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))


def wrong_prediction(label: str = "TX_FRAUD", prediction: str = "prediction") -> Column:
    """P10: the label differs from the (integer) prediction."""
    return F.col(label) != F.col(prediction).cast("int")


def rounded_ratio(num: Column, den: float, digits: int = 2) -> Column:
    """``round(num / den, digits)`` computed in double, HALF_UP."""
    return F.round(num.cast("double") / F.lit(float(den)), digits)
