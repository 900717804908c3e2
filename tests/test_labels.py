import random
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import plan_text, tx_rows
from txpipe.operators import labels as L
from txpipe.operators.picks import picks_per_day, smallest_share_per_group


def _brute_picks(ids, days, n):
    out = set()
    for d in days:
        order = sorted(set(ids), key=lambda i: ((i * 7919 + d * 104729) % 10007, i))
        out |= {(d, i) for i in order[:n]}
    return out


IDS = st.lists(st.integers(-(2**62), 2**62) | st.integers(-50, 50000), min_size=0, max_size=60)


@settings(max_examples=8, deadline=None)
@given(IDS, IDS, st.integers(1, 12), st.integers(1, 4), st.integers(1, 4))
def test_picks_of_two_kinds_equal_brute_force(spark, a, b, ndays, n, m):
    rows = [(i, None, 0) for i in a] + [(None, i, None) for i in b] + [(None, None, ndays)]
    tx = spark.createDataFrame(rows, "a long, b long, day long")
    got = sorted(map(tuple, picks_per_day(tx, {"a": n, "b": m}, "day").collect()))
    want = [("a", *p) for p in _brute_picks(a, range(ndays), n)] + [("b", *p) for p in _brute_picks(b, range(ndays), m)]
    assert got == sorted(want)


def test_many_candidates_on_one_residue(spark):
    ids = [7 + 10007 * k for k in range(40)] + list(range(0, 30000, 3))
    tx = spark.createDataFrame([(i, 9) for i in ids], "a long, day long")
    got = {(r[1], r[2]) for r in picks_per_day(tx, {"a": 5}, "day").collect()}
    assert got == _brute_picks(ids, range(9), 5)


def test_labels_read_the_transactions_once_for_all_picks(spark):
    from txpipe.sources.fixture import load_transactions

    picks = picks_per_day(load_transactions(spark, "/root/testdata/sf0.001"), {"TERMINAL_ID": 2, "CUSTOMER_ID": 3})
    text = plan_text(picks)
    assert text.count("FileScan") == 1 and "WindowGroupLimit" in text and "Join" not in text


def test_smallest_share_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(0, 5), rng.randrange(0, 3_000_000)) for _ in range(400)]
    rows = list({(g, i) for g, i in rows})
    df = spark.createDataFrame(rows, "g long, i long")
    got = {(r[0], r[1]) for r in smallest_share_per_group(df, "g", "i", 3).collect()}
    want = set()
    for g in {g for g, _ in rows}:
        ids = sorted((i for gg, i in rows if gg == g), key=lambda i: ((i * 7919 + g * 104729) % 1000003, i))
        want |= {(g, i) for i in ids[: len(ids) // 3]}
    assert got == want


def test_last_day_starts_nothing(spark):
    tx = tx_rows(spark, [(i, datetime(2024, 1, 1) + timedelta(days=i), 1, 1, 1.0) for i in range(5)])
    assert sorted(r[1] for r in picks_per_day(tx, {"CUSTOMER_ID": 1}).collect()) == [0, 1, 2, 3]
    one_day = tx_rows(spark, [(0, datetime(2024, 1, 1, 3), 1, 1, 1.0)])
    assert picks_per_day(one_day, {"CUSTOMER_ID": 1}).count() == 0
    assert picks_per_day(one_day.limit(0), {"CUSTOMER_ID": 1, "TERMINAL_ID": 2}).count() == 0


def test_precedence_and_compounding(spark):
    base = datetime(2024, 1, 1, 12)
    rows = [
        (1, base + timedelta(days=2), 10, 100, 300.0),  # s1 + s2 + s3 (picked twice)
        (2, base + timedelta(days=2), 11, 100, 300.0),  # s1 + s2
        (3, base + timedelta(days=2), 12, 200, 300.0),  # s1 only
        (4, base + timedelta(days=2), 12, 200, 10.0),  # nothing
        (5, base + timedelta(days=40), 11, 100, 5.0),  # terminal compromise expired
    ]
    tx = tx_rows(spark, rows)
    comp_t = spark.createDataFrame([(0, 100)], "start_day long, entity_id long")
    # customer 10 compromised on days 0 and 1 with one candidate each day:
    # floor(1/3) = 0 picks, so add two more candidates per day for customer 10
    extra = [(10 + i, base + timedelta(days=2, minutes=i), 10, 300, 1.0) for i in range(1, 3)]
    tx = tx.unionByName(tx_rows(spark, extra))
    comp_c = spark.createDataFrame([(0, 10), (1, 10)], "start_day long, entity_id long")
    lab = {r["TRANSACTION_ID"]: r for r in L.label_frauds(tx, comp_t, comp_c, with_hits=True).collect()}
    picked = [i for i in (1, 11, 12) if lab[i]["hit3"]]
    assert len(picked) == 1  # floor(3/3) = 1 per day, the same one both days
    p = picked[0]
    orig = {1: 300.0, 11: 1.0, 12: 1.0}[p]
    assert lab[p]["TX_AMOUNT"] == round(orig * 25, 2)  # picked on two days: x 5^2
    assert lab[p]["TX_FRAUD_SCENARIO"] == 3
    assert lab[2]["TX_FRAUD_SCENARIO"] == 2 and lab[2]["TX_FRAUD"] == 1
    assert lab[3]["TX_FRAUD_SCENARIO"] == 1
    assert lab[4]["TX_FRAUD_SCENARIO"] == 0 and lab[4]["TX_FRAUD"] == 0
    assert lab[5]["TX_FRAUD_SCENARIO"] == 0
    if p != 1:
        assert lab[1]["TX_FRAUD_SCENARIO"] == 2


def test_semi_join_is_broadcast(spark):
    from txpipe.sources.fixture import load_transactions

    tx = load_transactions(spark, "/root/testdata/sf0.001")
    text = plan_text(L.terminal_hits(tx))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_fixture_counts(spark):
    from txpipe.sources.fixture import load_transactions

    lab = L.label_frauds(load_transactions(spark, "/root/testdata/sf0.01"))
    counts = {r[0]: r[1] for r in lab.groupBy("TX_FRAUD_SCENARIO").count().collect()}
    assert counts == {0: 6544, 1: 80, 2: 2639, 3: 737}


def test_labelling_never_shuffles_transactions(spark):
    from helpers import streamed_path_nodes
    from txpipe.sources.fixture import load_transactions

    spark.catalog.clearCache()  # a cached copy of the input would replace the file scan
    nodes = streamed_path_nodes(L.label_frauds(load_transactions(spark, "/root/testdata/sf0.001")))
    assert "FileSourceScanExec" in nodes
    assert "BroadcastHashJoinExec" in nodes
    assert not any("Exchange" in n or n == "SortMergeJoinExec" for n in nodes), nodes
