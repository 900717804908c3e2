from datetime import datetime, timedelta

from pyspark.sql import functions as F

from helpers import exchanges, plan_text, tx_rows
from txpipe import schema as S
from txpipe.functions.columns import night_flag, weekend_flag
from txpipe.operators.features import add_rolling, build_features


def _feat(spark, rows):
    return {r["TRANSACTION_ID"]: r for r in build_features(tx_rows(spark, rows)).collect()}


def test_frame_edges(spark):
    t0 = datetime(2024, 1, 10, 12, 0, 0)
    rows = [
        (1, t0 - timedelta(days=1, microseconds=1), 7, 1, 10.0),  # just outside 1 day
        (2, t0 - timedelta(days=1), 7, 1, 20.0),  # exactly 1 day old: inside
        (3, t0, 7, 2, 30.0),
        (4, t0, 7, 1, 40.0),  # same timestamp as 3: peers
        (5, t0 - timedelta(days=7), 7, 1, 1.0),  # exactly 7 days
        (6, t0 - timedelta(days=30, microseconds=1), 7, 1, 500.0),  # outside 30 days
    ]
    f = _feat(spark, rows)
    r3 = f[3]
    assert r3["CUSTOMER_ID_NB_TX_1DAY_WINDOW"] == 3  # 2, 3, 4
    assert r3["CUSTOMER_ID_NB_TX_7DAY_WINDOW"] == 5  # + 1 and 5
    assert r3["CUSTOMER_ID_NB_TX_30DAY_WINDOW"] == 5  # 6 is 1 us too old
    assert r3["CUSTOMER_ID_MAX_AMOUNT_1DAY_WINDOW"] == 40.0
    assert r3["CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"] == 30.0
    assert r3["CUSTOMER_ID_MAX_AMOUNT_30DAY_WINDOW"] == 40.0
    assert f[4]["CUSTOMER_ID_NB_TX_1DAY_WINDOW"] == 3
    # customer-terminal pair: terminal 1 only
    assert r3["CUSTOMER_ID_TERMINAL_ID_NB_TX_1DAY_WINDOW"] == 1
    assert f[4]["CUSTOMER_ID_TERMINAL_ID_NB_TX_1DAY_WINDOW"] == 2
    assert f[6]["CUSTOMER_ID_NB_TX_30DAY_WINDOW"] == 1


def test_null_amount_and_fill(spark):
    t0 = datetime(2024, 1, 10, 12)
    f = _feat(spark, [(1, t0, 3, 1, None)])
    assert f[1]["CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"] == 0.0
    assert f[1]["CUSTOMER_ID_MAX_AMOUNT_1DAY_WINDOW"] == 0.0
    assert f[1]["TX_AMOUNT"] == 0.0
    assert f[1]["CUSTOMER_ID_NB_TX_1DAY_WINDOW"] == 1


def test_flags(spark):
    days = [datetime(2021, 12, d, 6, 59, 59) for d in range(1, 32)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp")
    got = [r[0] for r in df.orderBy("ts").select(weekend_flag("ts")).collect()]
    want = [1 if ((d - 1) % 7 + 1) >= 5 else 0 for d in range(1, 32)]
    assert got == want
    # Saturday 2021-12-04 -> aligned day 4 (flag 0); Sunday 12-05 -> 5 (flag 1)
    cal = {r[0].day: r[1] for r in df.select("ts", weekend_flag("ts", "calendar")).collect()}
    assert cal[4] == 1 and cal[5] == 1 and cal[6] == 0
    edge = spark.createDataFrame([(datetime(2024, 1, 1, 6, 59, 59),), (datetime(2024, 1, 1, 7, 0, 0),)], "ts timestamp")
    assert [r[0] for r in edge.orderBy("ts").select(night_flag("ts")).collect()] == [1, 0]


def test_one_exchange_and_no_python(spark):
    from txpipe.sources.fixture import load_transactions

    df = build_features(load_transactions(spark, "/root/testdata/sf0.001"))
    assert exchanges(df) == 1, plan_text(df)
    text = plan_text(df)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_window_invariants(spark):
    from txpipe.sources.fixture import load_transactions

    f = add_rolling(load_transactions(spark, "/root/testdata/sf0.01"))
    n = lambda d: F.col(f"CUSTOMER_ID_NB_TX_{d}DAY_WINDOW")
    m = lambda d: F.col(f"CUSTOMER_ID_MAX_AMOUNT_{d}DAY_WINDOW")
    a = lambda d: F.col(f"CUSTOMER_ID_AVG_AMOUNT_{d}DAY_WINDOW")
    p = lambda d: F.col(f"CUSTOMER_ID_TERMINAL_ID_NB_TX_{d}DAY_WINDOW")
    bad = f.where(
        (n(1) > n(7)) | (n(7) > n(30)) | (m(1) > m(7)) | (m(7) > m(30))
        | (p(1) > n(1)) | (p(7) > n(7)) | (p(30) > n(30))
        | (a(1) > m(1) + 1e-9) | (a(30) > m(30) + 1e-9)
    )
    assert bad.count() == 0


def test_history_days_warm_start(spark):
    t = [datetime(2024, 1, 1) + timedelta(days=d) for d in range(10)]
    df = tx_rows(spark, [(i, ts, 1, 1, 1.0) for i, ts in enumerate(t)])
    cold = build_features(df, begin_date="2024-01-05", end_date="2024-01-10")
    warm = build_features(df, begin_date="2024-01-05", end_date="2024-01-10", history_days=7)
    c = {r["TRANSACTION_ID"]: r["CUSTOMER_ID_NB_TX_7DAY_WINDOW"] for r in cold.collect()}
    w = {r["TRANSACTION_ID"]: r["CUSTOMER_ID_NB_TX_7DAY_WINDOW"] for r in warm.collect()}
    assert sorted(c) == sorted(w) == list(range(4, 10))
    assert c[4] == 1 and w[4] == 5  # days 0..4 within 7 days of day 4 (inclusive edge)


def test_hot_customer_block_plan_matches(spark):
    from txpipe.operators.features import SkewConfig
    from txpipe.sources.fixture import load_transactions

    tx = load_transactions(spark, "/root/testdata/sf0.001").cache()
    plain = build_features(tx, skew=None)
    for rpb in (1, 4):
        hot = build_features(tx, skew=SkewConfig(min_rows=5, rows_per_block=rpb))
        assert hot.dtypes == plain.dtypes
        assert hot.count() == plain.count()
        assert plain.exceptAll(hot.select(*plain.columns)).count() == 0


def test_hot_customer_frame_edges(spark):
    from txpipe.operators.features import SkewConfig

    t0 = datetime(2024, 1, 10, 12, 0, 0)
    rows = [
        (1, t0 - timedelta(days=1, microseconds=1), 7, 1, 10.0),
        (2, t0 - timedelta(days=1), 7, 1, 20.0),
        (3, t0, 7, 2, 30.0),
        (4, t0, 7, 1, 40.0),
        (5, t0 - timedelta(days=7), 7, 1, 1.0),
        (6, t0 - timedelta(days=30, microseconds=1), 7, 1, 500.0),
        (7, t0 - timedelta(days=30), 7, None, None),
    ]
    df = tx_rows(spark, rows)
    plain = build_features(df, skew=None)
    for rpb in (1, 2, 3):
        hot = build_features(df, skew=SkewConfig(min_rows=1, rows_per_block=rpb))
        assert sorted(plain.collect()) == sorted(hot.select(*plain.columns).collect())


def test_every_customer_above_the_threshold_is_hot(spark):
    from txpipe.operators.hotkeys import find_hot_keys
    from txpipe.sources.fixture import load_transactions

    tx = load_transactions(spark, "/root/testdata/sf0.01")
    counts = {r[0]: r[1] for r in tx.groupBy("CUSTOMER_ID").count().collect()}
    for least in (10, 100, 10_000):
        hot = find_hot_keys(tx, min_rows=least)
        want = {c for c, k in counts.items() if k > least}
        assert (hot is None) == (not want) and (hot is None or {r["_k"] for r in hot.collect()} == want)


def test_burst_with_a_stray_old_row_gets_short_blocks(spark):
    from txpipe.operators.features import SkewConfig, add_flags, add_rolling_skew_safe
    from txpipe.operators.hotkeys import find_hot_keys, mark_hot

    t0 = datetime(2024, 3, 10, 12)
    rows = [(i, t0 + timedelta(milliseconds=900 * i), 7, i % 3, float(i % 11)) for i in range(4000)]  # an hour
    rows += [(5000, datetime(2001, 1, 1), 7, 1, 3.0)] + [(6000 + i, t0 + timedelta(hours=i), 8, 1, 1.0) for i in range(400)]
    rows += [(7000 + i, t0 + timedelta(minutes=i), None, i % 2 or None, 0.004) for i in range(300)]
    df = tx_rows(spark, rows)
    df = df.unionByName(df.limit(250).withColumn("TRANSACTION_ID", F.col("TRANSACTION_ID") + 9000).withColumn("TX_DATETIME", F.lit(None).cast("timestamp")))
    hot = find_hot_keys(df, min_rows=250, rows_per_block=100)
    block = F.floor(F.unix_micros("TX_DATETIME") / F.col("_blk"))
    largest = mark_hot(df, hot).where("_blk is not null and TX_DATETIME is not null").groupBy("_k", block).count().agg(F.max("count")).first()[0]
    assert largest <= 200  # 4,401 of 5,000 rows are one customer's
    plain = build_features(df, skew=None)
    split = build_features(df, skew=SkewConfig(min_rows=250, rows_per_block=100))
    assert plain.exceptAll(split.select(*plain.columns)).count() == 0 and plain.count() == split.count()
    some = add_rolling_skew_safe(add_flags(df), SkewConfig(min_rows=250, rows_per_block=100), S.ROLLING[:1])
    assert some.columns[-1] == S.ROLLING_NAMES[0] and some.count() == df.count()


def test_middle_of_hot_customers_against_brute_force(spark):
    """Buckets of every block length, with gaps; no Python, and small windows."""
    import random

    from txpipe.operators import hotkeys as H

    rng = random.Random(4)
    rows = []
    for k, blk in enumerate(H.BLOCK_US):
        a_day = H.DAY_US // blk
        near = [rng.randrange(40 * a_day) for _ in range(20)]
        for b in sorted({x + d for x in near for d in (0, 1, 2, a_day, 7 * a_day - 1, 7 * a_day, 30 * a_day - 1, 30 * a_day)} | {-3, -a_day}):
            rows.append((k, blk, H.DAY_US, b, rng.randrange(1, 9), rng.choice([None, rng.random()])))
    df = spark.createDataFrame(rows, "k int, _blk long, _day long, b long, c long, x double").withColumn("_span", H._span(F.col("_blk")))
    out = H.between(df, ["k"], {"c": F.sum, "x": F.max})
    plan = plan_text(out)
    assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan
    got = {(r["k"], r["b"]): r for r in out.collect()}
    assert len(got) == len(rows)
    for k, blk, day, b, _, _ in rows:
        for n in H.SPANS:
            inside = [r for r in rows if r[0] == k and b - n * day // blk < r[3] < b]
            assert got[k, b][f"c_{n}"] == sum(r[4] for r in inside)
            assert got[k, b][f"x_{n}"] == max((r[5] for r in inside if r[5] is not None), default=None)
    for blk in H.BLOCK_US:
        span = H.SPAN_US.get(blk, H.DAY_US)
        assert span % blk == 0 and H.DAY_US % span == 0 and max(span // blk, H.DAY_US // span) <= H.SPAN_BLOCKS


def test_one_pair_with_most_rows_and_many_sparse_blocks(spark):
    """A burst sets blocks of 100 ms; 200,000 sparse rows of the same pair
    fill as many blocks. No window of the block tables takes more than a span."""
    from txpipe.operators import hotkeys as H

    burst = spark.range(3000).selectExpr("id", "timestamp_micros(1710072000000000 + id) ts", "1.0D amt")
    sparse = spark.range(200_000).selectExpr("id + 10000 id", "timestamp_micros(1709000000000000 + id * 10000007) ts", "2.0D amt")
    rest = spark.range(20_000).selectExpr("id + 1000000 id", "timestamp_micros(1709000000000000 + id * 50000000) ts", "3.0D amt")
    pair = burst.union(sparse).selectExpr("id", "ts", "7L c", "1L t", "amt")
    df = pair.union(rest.selectExpr("id", "ts", "id % 50 + 100 c", "id % 9 t", "amt")).selectExpr("id TRANSACTION_ID", "ts TX_DATETIME", "c CUSTOMER_ID", "t TERMINAL_ID", "amt TX_AMOUNT")
    hot = H.find_hot_keys(df, min_rows=10_000, rows_per_block=10)
    assert [tuple(r) for r in hot.collect()] == [(7, H.DAY_US // 864000)]
    marked = H.mark_hot(df, hot).where("_blk is not null")
    out = H.hot_rolling(marked, df.columns, S.ROLLING)
    assert "Pandas" not in plan_text(out) and "Python" not in plan_text(out)
    spans = marked.select(F.floor(F.unix_micros("TX_DATETIME") / H._span(F.col("_blk"))).alias("s"), F.floor(F.unix_micros("TX_DATETIME") / F.col("_blk")).alias("b")).distinct()
    assert spans.groupBy("s").count().agg(F.max("count")).first()[0] <= H.SPAN_BLOCKS
    names = [n for n in S.ROLLING_NAMES if "_1DAY" in n or "TERMINAL_ID_NB_TX_30" in n]
    got = out.where("TRANSACTION_ID % 997 = 0").select("TRANSACTION_ID", *names).collect()
    times = sorted((r[0], r[1]) for r in pair.selectExpr("unix_micros(ts)", "amt").collect())
    only = [t for t, _ in times]
    from bisect import bisect_left, bisect_right

    at = {r[0]: r[1] for r in pair.where("id % 997 = 0").selectExpr("id", "unix_micros(ts)").collect()}
    assert len(got) == len(at) > 200
    for r in got:
        t = at[r["TRANSACTION_ID"]]
        day = times[bisect_left(only, t - H.DAY_US) : bisect_right(only, t)]
        month = bisect_right(only, t) - bisect_left(only, t - 30 * H.DAY_US)
        assert r["CUSTOMER_ID_NB_TX_1DAY_WINDOW"] == len(day) == r["CUSTOMER_ID_TERMINAL_ID_NB_TX_1DAY_WINDOW"]
        assert r["CUSTOMER_ID_TERMINAL_ID_NB_TX_30DAY_WINDOW"] == month
        assert r["CUSTOMER_ID_MAX_AMOUNT_1DAY_WINDOW"] == max(a for _, a in day)
        assert abs(r["CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"] - sum(a for _, a in day) / len(day)) < 1e-12


def test_small_amounts_keep_their_average_and_finer_ones_fail(spark):
    import pytest

    t0 = datetime(2024, 1, 10, 12)
    f = _feat(spark, [(1, t0, 3, 1, 0.004), (2, t0, 3, 1, 0.000002)])
    assert f[1]["CUSTOMER_ID_AVG_AMOUNT_1DAY_WINDOW"] == 0.002001
    with pytest.raises(Exception, match="decimal places"):
        _feat(spark, [(1, t0, 3, 1, 0.0000001)])
