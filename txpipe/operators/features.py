"""Calendar flags and rolling customer features.

Every rolling feature is ``agg(value) OVER (PARTITION BY keys ORDER BY
TX_DATETIME RANGE BETWEEN INTERVAL n DAYS PRECEDING AND CURRENT ROW)``:
rows with the same timestamp are peers and a row exactly n days old is in
the frame. Interval frames keep microsecond precision.

Plan shape: all twelve windows share the order key, and the customer-terminal
windows are partitioned by the two plain keys, so one hash exchange on
``CUSTOMER_ID`` serves every window (a struct key would add a second one).
Averages are an exact decimal sum divided by the count, so they do not
depend on summation order; see ``schema.AMOUNT_SCALE``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.functions.columns import fill_numeric_nulls, night_flag, weekend_flag

TS = "TX_DATETIME"


def window_clause(keys: tuple[str, ...], days: int, ts: str = TS) -> str:
    return (
        f"PARTITION BY {', '.join(keys)} ORDER BY {ts} "
        f"RANGE BETWEEN INTERVAL {int(days)} DAYS PRECEDING AND CURRENT ROW"
    )


def exact_amount(v: str) -> str:
    """``v`` as a decimal; an amount with more places than the scale fails."""
    dec = f"DECIMAL(24,{S.AMOUNT_SCALE})"
    fail = f"CAST(raise_error('{v} has an amount with more than {S.AMOUNT_SCALE} decimal places') AS {dec})"
    return f"CASE WHEN {v} IS NULL OR CAST(CAST({v} AS {dec}) AS DOUBLE) = {v} THEN CAST({v} AS {dec}) ELSE {fail} END"


def rolling_expression(spec: S.RollingSpec, window: str) -> str:
    """SQL text of one rolling feature over ``window``."""
    v = spec.value
    if spec.agg == "avg":
        return f"CAST(SUM({exact_amount(v)}) OVER ({window}) AS DOUBLE) / NULLIF(COUNT({v}) OVER ({window}), 0)"
    if spec.agg in ("count", "max"):
        return f"{spec.agg.upper()}({v}) OVER ({window})"
    raise ValueError(spec.agg)


def rolling_column(spec: S.RollingSpec, ts: str = TS) -> Column:
    """One rolling feature as a window expression."""
    return F.expr(rolling_expression(spec, window_clause(spec.keys, spec.days, ts))).alias(spec.name)


def add_flags(df: DataFrame, weekend_mode: str = "aligned", ts: str = TS) -> DataFrame:
    """Night and weekend flags (int)."""
    return df.withColumn("TX_DURING_NIGHT", night_flag(ts)).withColumn(
        "TX_DURING_WEEKEND", weekend_flag(ts, weekend_mode)
    )


def add_rolling(df: DataFrame, specs: list[S.RollingSpec] | None = None) -> DataFrame:
    """Append rolling features (all windows in one select, so
    Catalyst groups them into Window nodes over a single exchange)."""
    specs = specs if specs is not None else S.ROLLING
    return df.select("*", *[rolling_column(s) for s in specs])


@dataclass(frozen=True)
class SkewConfig:
    """Hot-customer split for the rolling features: every customer (and the
    rows without one) with more than ``min_rows`` rows takes the block plan of
    :mod:`txpipe.operators.hotkeys`, with blocks of about ``rows_per_block`` of
    the customer's rows at their densest. ``None`` disables the split."""

    min_rows: int = 20_000
    rows_per_block: int = 1_000_000


def add_rolling_skew_safe(df: DataFrame, skew: SkewConfig | None = SkewConfig(), specs: list[S.RollingSpec] | None = None) -> DataFrame:
    """W1-W12 (or some of them) with hot customers split out: the plain window
    plan for the rest, the block plan for hot customers, then a union (same
    values). The hot list is joined once, and its flag splits the rows."""
    specs = specs if specs is not None else S.ROLLING
    if skew is None:
        return add_rolling(df, specs)
    from txpipe.operators.hotkeys import find_hot_keys, hot_rolling, mark_hot

    hot = find_hot_keys(df, skew.min_rows, skew.rows_per_block)
    if hot is None:
        return add_rolling(df, specs)
    marked = mark_hot(df, hot)
    cold = add_rolling(marked.where("_blk is null").select(*df.columns), specs)
    out = cold.unionByName(hot_rolling(marked.where("_blk is not null"), df.columns, specs))
    return out.select(*df.columns, *[s.name for s in specs])


def build_features(
    tx: DataFrame,
    weekend_mode: str = "aligned",
    begin_date: str | None = None,
    end_date: str | None = None,
    history_days: int = 0,
    fill_nulls: bool = True,
    skew: SkewConfig | None = SkewConfig(),
) -> DataFrame:
    """Flags + twelve rolling features + NULL -> 0.

    ``begin_date``/``end_date`` (inclusive dates) cut the output. With
    ``history_days`` > 0 (Q4) the windows also see that many days before
    ``begin_date``; those rows are read, used as history, then dropped. The
    default 0 starts cold, as the reference does. ``skew`` sends customers
    above a row threshold through the block plan (see ``SkewConfig``).
    """
    src = tx
    if begin_date is not None:
        lo = F.date_sub(F.lit(begin_date).cast("date"), int(history_days))
        src = src.where(F.to_date(TS) >= lo)
    if end_date is not None:
        src = src.where(F.to_date(TS) <= F.lit(end_date).cast("date"))
    out = add_rolling_skew_safe(add_flags(src, weekend_mode), skew)
    if begin_date is not None and history_days:
        out = out.where(F.to_date(TS) >= F.lit(begin_date).cast("date"))
    return fill_numeric_nulls(out) if fill_nulls else out


def rolling_sql_text(view: str, specs: list[S.RollingSpec] | None = None) -> str:
    """The twelve windows as one SQL statement over a registered view."""
    specs = specs if specs is not None else S.ROLLING
    cols = [f"{rolling_expression(s, window_clause(s.keys, s.days))} AS {s.name}" for s in specs]
    return f"SELECT *, {', '.join(cols)} FROM {view}"


def build_features_sql(tx: DataFrame, view: str = "tx_flags", weekend_mode: str = "aligned", skew: SkewConfig | None = SkewConfig()) -> DataFrame:
    """S15 + W13 the reference's way: flags in the DataFrame API, a temp
    view, the windows as SQL text over it, then NULL -> 0. Hot customers' rows
    stay out of the view and take the block plan."""
    from txpipe.operators.hotkeys import find_hot_keys, hot_rolling, mark_hot

    flagged = add_flags(tx, weekend_mode)
    hot = find_hot_keys(flagged, skew.min_rows, skew.rows_per_block) if skew else None
    marked = mark_hot(flagged, hot) if hot is not None else None
    cold = flagged if hot is None else marked.where("_blk is null").select(*flagged.columns)
    cold.createOrReplaceTempView(view)
    out = tx.sparkSession.sql(rolling_sql_text(view))
    if hot is not None:
        out = out.unionByName(hot_rolling(marked.where("_blk is not null"), flagged.columns, S.ROLLING))
    return fill_numeric_nulls(out.select(*flagged.columns, *S.ROLLING_NAMES))
