"""Queries for the customer-terminal radius join."""

from __future__ import annotations

from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.functions.columns import fill_numeric_nulls
from txpipe.operators.spatial import radius_pairs, terminals_within_radius
from txpipe.plans.registry import query
from txpipe.sources.fixture import customer_profiles, terminal_profiles

PROFILES = """WITH c AS (
  SELECT c_custkey AS CUSTOMER_ID,
         CAST((c_custkey * 7919) % 10007 AS DOUBLE) / CAST(100.07 AS DOUBLE) AS x,
         CAST((c_custkey * 104729) % 10007 AS DOUBLE) / CAST(100.07 AS DOUBLE) AS y
  FROM customer),
t AS (
  SELECT s_suppkey AS TERMINAL_ID,
         CAST((s_suppkey * 15485863) % 10007 AS DOUBLE) / CAST(100.07 AS DOUBLE) AS x,
         CAST((s_suppkey * 32452843) % 10007 AS DOUBLE) / CAST(100.07 AS DOUBLE) AS y
  FROM supplier),
p AS (
  SELECT c.CUSTOMER_ID, t.TERMINAL_ID,
         sqrt((c.x - t.x) * (c.x - t.x) + (c.y - t.y) * (c.y - t.y)) AS distance
  FROM c, t
  WHERE sqrt((c.x - t.x) * (c.x - t.x) + (c.y - t.y) * (c.y - t.y)) < 5.0)
"""


@query(
    "j1_terminals_in_radius",
    PROFILES
    + """SELECT c.CUSTOMER_ID AS CUSTOMER_ID, CAST(count(p.TERMINAL_ID) AS INTEGER) AS nb_terminals,
       COALESCE(string_agg(CAST(p.TERMINAL_ID AS VARCHAR), ',' ORDER BY p.TERMINAL_ID), '') AS available_terminals
FROM c LEFT JOIN p ON c.CUSTOMER_ID = p.CUSTOMER_ID GROUP BY c.CUSTOMER_ID""",
)
def j1(spark, sf):
    """Reference layout: sorted terminal list per customer (as text here for
    an engine-neutral comparison) and its size (P15)."""
    out = terminals_within_radius(customer_profiles(spark, sf), terminal_profiles(spark, sf), S.DEFAULT_RADIUS)
    return out.select("CUSTOMER_ID", "nb_terminals", F.array_join("available_terminals", ",").alias("available_terminals"))


@query("j1_radius_pairs", PROFILES + "SELECT CUSTOMER_ID, TERMINAL_ID, distance FROM p")
def j1_pairs(spark, sf):
    """Long form with the Euclidean distance."""
    return radius_pairs(customer_profiles(spark, sf), terminal_profiles(spark, sf), S.DEFAULT_RADIUS)


@query(
    "p5_fill_nulls_nearest_terminal",
    PROFILES
    + """SELECT c.CUSTOMER_ID AS CUSTOMER_ID, COALESCE(min(p.distance), 0) AS nearest_distance
FROM c LEFT JOIN p ON c.CUSTOMER_ID = p.CUSTOMER_ID GROUP BY c.CUSTOMER_ID""",
)
def p5(spark, sf):
    """P5: customers with no terminal in range get 0 after ``fillna(0)``."""
    cust = customer_profiles(spark, sf)
    near = radius_pairs(cust, terminal_profiles(spark, sf), S.DEFAULT_RADIUS).groupBy("CUSTOMER_ID").agg(
        F.min("distance").alias("nearest_distance")
    )
    return fill_numeric_nulls(cust.select("CUSTOMER_ID").join(near, "CUSTOMER_ID", "left"))
