"""Column names, feature lists, window specification and stream schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: these must equal the reference's for equal results. ---
# Fraud scenarios: amount threshold; terminals per day and days compromised;
# customers per day, days compromised, share kept (1/3) and amount factor.
SCENARIO1_AMOUNT = 220
SCENARIO2_PER_DAY = 2
SCENARIO2_DAYS = 28
SCENARIO3_PER_DAY = 3
SCENARIO3_DAYS = 14
SCENARIO3_SHARE_DIVISOR = 3
SCENARIO3_AMOUNT_FACTOR = 5
# Night is hour <= 6; "weekend" is the aligned day-of-week-in-month >= 5.
NIGHT_LAST_HOUR = 6
WEEKEND_FIRST_ALIGNED_DAY = 5
# Rolling window spans in days.
WINDOW_DAYS = (1, 7, 30)
# Train/test cut used by the reference notebooks.
TRAIN_RANGE = ("2021-09-01", "2021-12-01")
TEST_RANGE = ("2021-12-09", "2021-12-31")
# Hourly dashboard divides the hourly transaction count by this.
HOURLY_COUNT_DIVISOR = 30
# Customer-terminal radius.
DEFAULT_RADIUS = 5.0
# --- end of fixed values ---

# Amounts are summed exactly, as decimals with this many places; an amount that
# needs more makes the query fail rather than lose digits.
AMOUNT_SCALE = 6

TX_BASE = [
    "TRANSACTION_ID",
    "TX_DATETIME",
    "CUSTOMER_ID",
    "TERMINAL_ID",
    "TX_AMOUNT",
    "TX_TIME_SECONDS",
    "TX_TIME_DAYS",
]
TX_LABELS = ["TX_FRAUD", "TX_FRAUD_SCENARIO"]
FLAGS = ["TX_DURING_NIGHT", "TX_DURING_WEEKEND"]


@dataclass(frozen=True)
class RollingSpec:
    """One rolling feature: aggregate of ``value`` over ``days`` per ``keys``."""

    name: str
    agg: str  # avg | count | max
    keys: tuple[str, ...]
    value: str
    days: int


def _rolling_specs() -> list[RollingSpec]:
    specs: list[RollingSpec] = []
    cust = ("CUSTOMER_ID",)
    pair = ("CUSTOMER_ID", "TERMINAL_ID")
    for n in WINDOW_DAYS:
        specs.append(RollingSpec(f"CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW", "avg", cust, "TX_AMOUNT", n))
    for n in WINDOW_DAYS:
        specs.append(RollingSpec(f"CUSTOMER_ID_NB_TX_{n}DAY_WINDOW", "count", cust, "TRANSACTION_ID", n))
    for n in WINDOW_DAYS:
        specs.append(RollingSpec(f"CUSTOMER_ID_TERMINAL_ID_NB_TX_{n}DAY_WINDOW", "count", pair, "TRANSACTION_ID", n))
    for n in WINDOW_DAYS:
        specs.append(RollingSpec(f"CUSTOMER_ID_MAX_AMOUNT_{n}DAY_WINDOW", "max", cust, "TX_AMOUNT", n))
    return specs


ROLLING = _rolling_specs()
ROLLING_NAMES = [s.name for s in ROLLING]

# Model input, in order (one shared list for training and scoring).
FEATURES = ["TX_AMOUNT", *FLAGS] + [
    f"CUSTOMER_ID_AVG_AMOUNT_{n}DAY_WINDOW" for n in WINDOW_DAYS
] + [f"CUSTOMER_ID_NB_TX_{n}DAY_WINDOW" for n in WINDOW_DAYS] + [
    f"CUSTOMER_ID_TERMINAL_ID_NB_TX_{n}DAY_WINDOW" for n in WINDOW_DAYS
] + [f"CUSTOMER_ID_MAX_AMOUNT_{n}DAY_WINDOW" for n in WINDOW_DAYS]

FEATURE_TABLE = TX_BASE + TX_LABELS + FLAGS + ROLLING_NAMES


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType(), True)


def _double(name: str) -> T.StructField:
    return T.StructField(name, T.DoubleType(), True)


def message_schema() -> T.StructType:
    """Schema of one JSON stream message: ``index`` plus the feature table,
    with ``TX_DATETIME`` as text and flags as longs."""
    fields = [_long("index"), _long("TRANSACTION_ID"), T.StructField("TX_DATETIME", T.StringType(), True)]
    fields += [_long("CUSTOMER_ID"), _long("TERMINAL_ID"), _double("TX_AMOUNT")]
    fields += [_long(c) for c in ("TX_TIME_SECONDS", "TX_TIME_DAYS", *TX_LABELS, *FLAGS)]
    for spec in ROLLING:
        fields.append(_double(spec.name) if spec.agg in ("avg", "max") else _long(spec.name))
    return T.StructType(fields)


def scored_schema_columns() -> list[str]:
    """Columns of a scored message (``index`` dropped)."""
    return [f.name for f in message_schema().fields if f.name != "index"]
