import random

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import plan_text
from pyspark.sql import functions as F

from txpipe.functions.columns import distance
from txpipe.operators.spatial import radius_pairs, terminals_within_radius


def brute_force_pairs(customers, terminals, r):
    """Every pair checked (nested loop): the reference semantics, tests only."""
    d = distance(F.col("x_customer_id"), F.col("y_customer_id"), F.col("x_terminal_id"), F.col("y_terminal_id"))
    return customers.crossJoin(terminals).where(d < F.lit(float(r))).select("CUSTOMER_ID", "TERMINAL_ID")


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([1.0, 5.0, 12.5]))
def test_grid_equals_brute_force(spark, seed, r):
    rng = random.Random(seed)
    cust = spark.createDataFrame([(i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(60)],
                                 "CUSTOMER_ID long, x_customer_id double, y_customer_id double")
    term = spark.createDataFrame([(i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(80)],
                                 "TERMINAL_ID long, x_terminal_id double, y_terminal_id double")
    got = {(a, b) for a, b, _ in radius_pairs(cust, term, r).collect()}
    split = sorted((a, b) for a, b, _ in radius_pairs(cust, term, r, cell_terminals=2).collect())
    assert split == sorted(got)  # crowded cells over salts: the same pairs, each once
    want = {(a, b) for a, b in brute_force_pairs(cust, term, r).collect()}
    assert got == want


def test_exact_radius_excluded_and_empty_list(spark):
    cust = spark.createDataFrame([(1, 10.0, 10.0), (2, 90.0, 90.0)], "CUSTOMER_ID long, x_customer_id double, y_customer_id double")
    term = spark.createDataFrame([(0, 15.0, 10.0), (1, 12.0, 10.0), (2, 10.0, 6.0)],
                                 "TERMINAL_ID long, x_terminal_id double, y_terminal_id double")
    out = {r["CUSTOMER_ID"]: r for r in terminals_within_radius(cust, term, 5.0).collect()}
    assert out[1]["available_terminals"] == [1, 2]  # terminal 0 at exactly 5.0 is out
    assert out[1]["nb_terminals"] == 2
    assert out[2]["available_terminals"] == [] and out[2]["nb_terminals"] == 0


def test_no_nested_loop(spark):
    from txpipe.sources.fixture import customer_profiles, terminal_profiles

    df = terminals_within_radius(customer_profiles(spark, "/root/testdata/sf0.001"), terminal_profiles(spark, "/root/testdata/sf0.001"), 5.0)
    text = plan_text(df)
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_candidates_of_a_task_are_bounded(spark):
    """Few bytes, many pairs: 400 customers and 100 terminals on one spot."""
    cust = spark.range(400).selectExpr("id AS CUSTOMER_ID", "50.5D AS x_customer_id", "50.5D AS y_customer_id").coalesce(1)
    term = spark.range(100).selectExpr("id AS TERMINAL_ID", "51D AS x_terminal_id", "51D AS y_terminal_id").coalesce(1)
    pairs = radius_pairs(cust, term, 5.0, task_candidates=2_000)
    of_task = [r["count"] for r in pairs.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(of_task) == 40_000 and max(of_task) <= 3 * 2_000
    lists = pairs.groupBy("CUSTOMER_ID").agg(F.collect_list("TERMINAL_ID"))
    assert plan_text(lists).count("Exchange hashpartitioning") == 1  # pairs are not moved
