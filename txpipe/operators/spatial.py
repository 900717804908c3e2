"""Customer-terminal radius join.

Terminals strictly closer than ``r`` to each customer. A plain theta join
would be a nested loop over customers x terminals; here both sides get a
grid cell of side ``r``, each customer is expanded to its 3 x 3 neighbour
cells (9 rows), and an equi-join on the cell finds every candidate within
``r`` -- then the exact distance filter keeps ``dist < r``. A crowded cell would
be one hot join key: its terminals are dealt over salts by a hash of their id,
about ``cell_terminals`` to a salt, and its customers come once for each salt.

The work is in the candidates, not in the bytes of either side, so customers are
dealt over as many tasks as there are ``task_candidates`` of candidates (and cells
to look in), counted by cell first. Pairs stay with their customer while terminals
are small enough to broadcast: what is grouped by customer after is not moved again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txpipe.session import stored

CELL_TERMINALS = 10_000
TASK_CANDIDATES = 20_000_000
MOST_TASKS = 50_000


def _cell(c: str, r: float):
    return F.floor(F.col(c) / F.lit(float(r))).cast("bigint")


def _neighbours(rows: DataFrame, *cols: str) -> DataFrame:
    """Each row once for its own cell and each of the eight around it."""
    offsets = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    out = rows.withColumn("_ox", F.explode(offsets)).withColumn("_oy", F.explode(offsets))
    return out.select(*cols, (F.col("_bx") + F.col("_ox")).alias("_gx"), (F.col("_by") + F.col("_oy")).alias("_gy"))


def radius_pairs(
    customers: DataFrame,
    terminals: DataFrame,
    r: float,
    cust_cols: tuple[str, str, str] = ("CUSTOMER_ID", "x_customer_id", "y_customer_id"),
    term_cols: tuple[str, str, str] = ("TERMINAL_ID", "x_terminal_id", "y_terminal_id"),
    cell_terminals: int = CELL_TERMINALS,
    task_candidates: int = TASK_CANDIDATES,
) -> DataFrame:
    """Long form ``(CUSTOMER_ID, TERMINAL_ID, distance)`` with ``distance < r``."""
    cid, cx, cy = cust_cols
    tid, tx, ty = term_cols
    own = customers.select(
        F.col(cid).alias("_cid"),
        F.col(cx).alias("_cx"),
        F.col(cy).alias("_cy"),
        _cell(cx, r).alias("_bx"),
        _cell(cy, r).alias("_by"),
    )
    term = terminals.select(
        F.col(tid).alias("_tid"),
        F.col(tx).alias("_tx"),
        F.col(ty).alias("_ty"),
        _cell(tx, r).alias("_gx"),
        _cell(ty, r).alias("_gy"),
    )
    keys = ["_gx", "_gy"]
    cells = _neighbours(own.groupBy("_bx", "_by").agg(F.count("*").alias("_n")), "_n")
    work = cells.join(term.groupBy(*keys).agg(F.count("*").alias("_m")), keys, "left").agg(F.sum(F.col("_n") * (1.0 + F.coalesce("_m", F.lit(0)))).alias("work")).first()["work"]
    tasks = min(MOST_TASKS, max(1, math.ceil((work or 0) / task_candidates)))
    cust = _neighbours(own.repartition(tasks, "_cid"), "_cid", "_cx", "_cy")
    # At most terminals / cell_terminals rows; stored, so joined by its bytes.
    crowded = stored(term.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > F.lit(cell_terminals)), "crowded-cells")
    if not crowded.isEmpty():
        salts = crowded.select(*keys, F.ceil(F.col("n") / F.lit(cell_terminals)).cast("int").alias("_salts"))
        count = F.coalesce("_salts", F.lit(1))
        term = term.join(salts, keys, "left").withColumn("_salt", F.pmod(F.xxhash64("_tid"), count).cast("int")).drop("_salts")
        cust = cust.join(salts, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), count - 1))).drop("_salts")
        keys = [*keys, "_salt"]
    dx = F.col("_cx") - F.col("_tx")
    dy = F.col("_cy") - F.col("_ty")
    dist = F.sqrt(dx * dx + dy * dy)
    return (
        cust.join(term, keys)
        .select(F.col("_cid").alias(cid), F.col("_tid").alias(tid), dist.alias("distance"))
        .where(F.col("distance") < F.lit(float(r)))
    )


def terminals_within_radius(customers: DataFrame, terminals: DataFrame, r: float) -> DataFrame:
    """The reference's profile columns: ``available_terminals`` (sorted ids,
    empty when none) and ``nb_terminals`` (P15) for every customer."""
    pairs = radius_pairs(customers, terminals, r)
    lists = pairs.groupBy("CUSTOMER_ID").agg(F.sort_array(F.collect_list("TERMINAL_ID")).alias("_terms"))
    out = customers.join(lists, "CUSTOMER_ID", "left")
    terms = F.coalesce(F.col("_terms"), F.array().cast("array<bigint>"))
    return out.select(*customers.columns, terms.alias("available_terminals"), F.size(terms).cast("int").alias("nb_terminals"))
