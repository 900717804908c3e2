"""DuckDB SQL for each registered query (the independent oracle).

Written against the raw shared tables (``events``, ``customer``,
``supplier``); the CTEs below rebuild the transaction model the same way the
Spark side does, using the fixed mapping constants.
"""

from __future__ import annotations

from txpipe import schema as S

TX = """tx AS (
  SELECT event_id AS TRANSACTION_ID,
         ts AS TX_DATETIME,
         user_id AS CUSTOMER_ID,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS TERMINAL_ID,
         value AS TX_AMOUNT,
         CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000) AS BIGINT) AS TX_TIME_SECONDS,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS TX_TIME_DAYS
  FROM events)"""

PICKS = """days AS (
  SELECT unnest(range(0, (SELECT max(TX_TIME_DAYS) FROM tx))) AS start_day),
ct AS (
  SELECT start_day, id AS entity_id FROM (
    SELECT d.start_day, e.id,
           row_number() OVER (PARTITION BY d.start_day ORDER BY (((e.id % 10007) + 10007) % 10007 * 7919 + d.start_day * 104729) % 10007, e.id) AS rn
    FROM (SELECT DISTINCT TERMINAL_ID AS id FROM tx WHERE TERMINAL_ID IS NOT NULL) e, days d)
  WHERE rn <= 2),
cc AS (
  SELECT start_day, id AS entity_id FROM (
    SELECT d.start_day, e.id,
           row_number() OVER (PARTITION BY d.start_day ORDER BY (((e.id % 10007) + 10007) % 10007 * 7919 + d.start_day * 104729) % 10007, e.id) AS rn
    FROM (SELECT DISTINCT CUSTOMER_ID AS id FROM tx WHERE CUSTOMER_ID IS NOT NULL) e, days d)
  WHERE rn <= 3),
s2 AS (
  SELECT DISTINCT t.TRANSACTION_ID FROM tx t JOIN ct
    ON t.TERMINAL_ID = ct.entity_id AND t.TX_TIME_DAYS >= ct.start_day AND t.TX_TIME_DAYS < ct.start_day + 28),
c3 AS (
  SELECT t.TRANSACTION_ID, cc.start_day FROM tx t JOIN cc
    ON t.CUSTOMER_ID = cc.entity_id AND t.TX_TIME_DAYS >= cc.start_day AND t.TX_TIME_DAYS < cc.start_day + 14),
c3pick AS (
  SELECT TRANSACTION_ID, start_day FROM (
    SELECT TRANSACTION_ID, start_day,
           row_number() OVER (PARTITION BY start_day ORDER BY (((TRANSACTION_ID % 1000003) + 1000003) % 1000003 * 7919 + start_day * 104729) % 1000003, TRANSACTION_ID) AS rn,
           count(*) OVER (PARTITION BY start_day) AS n
    FROM c3)
  WHERE rn <= n // 3),
p3 AS (SELECT TRANSACTION_ID, count(*) AS times FROM c3pick GROUP BY TRANSACTION_ID)"""

LAB = """lab AS (
  SELECT t.TRANSACTION_ID, t.TX_DATETIME, t.CUSTOMER_ID, t.TERMINAL_ID,
         CASE WHEN p3.times IS NOT NULL THEN round(t.TX_AMOUNT * pow(5.0, p3.times), 2) ELSE t.TX_AMOUNT END AS TX_AMOUNT,
         t.TX_TIME_SECONDS, t.TX_TIME_DAYS,
         CAST(CASE WHEN p3.times IS NOT NULL OR s2.TRANSACTION_ID IS NOT NULL OR t.TX_AMOUNT > 220 THEN 1 ELSE 0 END AS BIGINT) AS TX_FRAUD,
         CAST(CASE WHEN p3.times IS NOT NULL THEN 3 WHEN s2.TRANSACTION_ID IS NOT NULL THEN 2
                   WHEN t.TX_AMOUNT > 220 THEN 1 ELSE 0 END AS BIGINT) AS TX_FRAUD_SCENARIO,
         CASE WHEN t.TX_AMOUNT > 100 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction,
         COALESCE(t.TX_AMOUNT > 220, false) AS hit1, s2.TRANSACTION_ID IS NOT NULL AS hit2, p3.times IS NOT NULL AS hit3
  FROM tx t LEFT JOIN s2 ON t.TRANSACTION_ID = s2.TRANSACTION_ID LEFT JOIN p3 ON t.TRANSACTION_ID = p3.TRANSACTION_ID)"""

LAB_COLS = (
    "TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_SECONDS, TX_TIME_DAYS, "
    "TX_FRAUD, TX_FRAUD_SCENARIO"
)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def labelled_prefix() -> str:
    return with_(TX, PICKS, LAB)


def _win(keys: tuple[str, ...], days: int) -> str:
    return (
        f"(PARTITION BY {', '.join(keys)} ORDER BY TX_DATETIME "
        f"RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND CURRENT ROW)"
    )


def rolling_sql(spec: S.RollingSpec) -> str:
    w = _win(spec.keys, spec.days)
    v = spec.value
    if spec.agg == "avg":
        return f"CAST(SUM(CAST({v} AS DECIMAL(24,6))) OVER {w} AS DOUBLE) / NULLIF(COUNT({v}) OVER {w}, 0)"
    if spec.agg == "count":
        return f"COUNT({v}) OVER {w}"
    return f"MAX({v}) OVER {w}"


NIGHT = "CASE WHEN hour(TX_DATETIME) <= 6 THEN 1 ELSE 0 END"
WEEKEND_ALIGNED = "CASE WHEN (day(TX_DATETIME) - 1) % 7 + 1 >= 5 THEN 1 ELSE 0 END"
WEEKEND_CALENDAR = "CASE WHEN isodow(TX_DATETIME) >= 6 THEN 1 ELSE 0 END"


def features_cte(source: str = "lab", cols: str = LAB_COLS, name: str = "feat") -> str:
    """Flags + twelve rolling features + COALESCE(.., 0) over ``source``."""
    roll = ",\n         ".join(f"{rolling_sql(s)} AS {s.name}" for s in S.ROLLING)
    base = [c.strip() for c in cols.split(",")]
    numeric_nullable = {"TERMINAL_ID", "TX_AMOUNT", "CUSTOMER_ID", "TX_TIME_SECONDS", "TX_TIME_DAYS", "TRANSACTION_ID"}
    outer = [f"COALESCE({c}, 0) AS {c}" if c in numeric_nullable else c for c in base]
    outer += ["TX_DURING_NIGHT", "TX_DURING_WEEKEND"] + [f"COALESCE({s.name}, 0) AS {s.name}" for s in S.ROLLING]
    return f"""{name} AS (
  SELECT {', '.join(outer)} FROM (
    SELECT {cols}, {NIGHT} AS TX_DURING_NIGHT, {WEEKEND_ALIGNED} AS TX_DURING_WEEKEND,
         {roll}
    FROM {source}) z)"""
