"""Deterministic per-group choices by integer hashing.

``picks_per_day`` chooses, for every start day, the ``n`` entities with the
smallest ``((id * id_mult + day * day_mult) mod modulus, id)`` -- the same
integer arithmetic the DuckDB oracle runs, so both engines pick alike. Ids and
days are reduced by the modulus before they are multiplied (a non-negative
remainder), so negative and very large ids neither vanish nor overflow.

It never pairs every entity with every day, and reads the transactions once
for all kinds of entities: one keyed aggregate over (kind, id) finds the distinct
ids and days. Entities are then reduced to at most ``n`` per hash residue (a
map-side WindowGroupLimit), which bounds that table by ``n * modulus`` rows a
kind whatever the data size. A day's order over residues is a rotation of the
residues' own order: with the candidates of a kind in one array by (residue,
id), a day's picks are ``n`` consecutive entries, counted on around the circle
from the first one at or after the day's residue. Everything is one lazy plan;
nothing is counted first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txpipe.session import stored

# --- Fixed values: hash constants of the deterministic choices. ---
ID_MULT = 7919
DAY_MULT = 104729
ENTITY_MODULUS = 10007
ROW_MODULUS = 1000003
# --- end of fixed values ---


def residue(id_col: Column, mult: int, modulus: int) -> Column:
    """``id * mult mod modulus`` in ``0 .. modulus - 1`` without overflow."""
    return F.pmod(F.pmod(id_col, F.lit(modulus)) * F.lit(mult), F.lit(modulus))


def day_hash(id_col: Column, day_col: Column, modulus: int, id_mult: int = ID_MULT, day_mult: int = DAY_MULT) -> Column:
    """``(id * id_mult + day * day_mult) mod modulus``."""
    return F.pmod(residue(id_col, id_mult, modulus) + residue(day_col, day_mult, modulus), F.lit(modulus))


def picks_per_day(tx: DataFrame, wanted: dict[str, int], day_col: str = "TX_TIME_DAYS", id_mult: int = ID_MULT, day_mult: int = DAY_MULT, modulus: int = ENTITY_MODULUS) -> DataFrame:
    """Rows ``(kind, start_day, entity_id)``: for each id column in ``wanted``
    (the kind) its number of picks for each of the days ``0 .. max(day) - 1``;
    the last day starts nothing. Fewer only where there are fewer distinct ids."""
    days = ""  # the kind under which the days themselves go through the same aggregate

    def entry(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("bigint").alias("id"))

    entries = F.array(*[entry(c, F.col(c)) for c in wanted], entry(days, F.col(day_col)))
    seen = tx.select(F.explode(entries).alias("e")).select("e.*").where(F.col("id").isNotNull()).distinct()
    is_day = F.col("kind") == days
    seen = seen.withColumn("residue", F.when(is_day, 0).otherwise(residue(F.col("id"), id_mult, modulus)))
    least_first = Window.partitionBy("kind", "residue").orderBy(F.when(is_day, -F.col("id")).otherwise(F.col("id")))
    cand = seen.withColumn("rn", F.row_number().over(least_first)).where(F.col("rn") <= max(wanted.values()))
    # One row: the last day, and for each kind at most n * modulus candidates.
    circles = []
    for kind, n in wanted.items():
        mine = (F.col("kind") == kind) & (F.col("rn") <= n)
        circles.append(F.array_sort(F.collect_list(F.when(mine, F.struct("residue", "id")))).alias(f"_{kind}"))
    one = cand.agg(F.max(F.when(is_day, F.col("id"))).alias("last"), *circles).where(F.col("last") >= 1)

    def first_at(circle: Column, start: Column, n: int) -> Column:
        """Index of the first candidate at or after a residue, by halving."""
        halve = lambda s, m: F.when(s["lo"] >= s["hi"], s).when(F.get(circle, m)["residue"] < start, F.struct((m + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), m.alias("hi")))
        middle = lambda s: F.shiftright(s["lo"] + s["hi"], 1)
        whole = F.struct(F.lit(0).alias("lo"), F.size(circle).alias("hi"))
        turns = F.sequence(F.lit(1), F.lit((n * modulus).bit_length() + 1))
        return F.aggregate(turns, whole, lambda s, _: halve(s, middle(s)), lambda s: s["lo"])

    def picked(kind: str, n: int, day: Column) -> Column:
        circle = F.col(f"_{kind}")
        start = F.pmod(-residue(day, day_mult, modulus), F.lit(modulus))
        around = lambda first: F.transform(F.sequence(F.lit(1), F.least(F.lit(n), F.size(circle))), lambda j: F.get(circle, F.pmod(first + j - 1, F.size(circle)))["id"])
        ids = F.flatten(F.transform(F.array(first_at(circle, start, n)), around))
        return F.when(F.size(circle) > 0, ids).otherwise(F.array().cast("array<bigint>"))

    def rows_of(kind: str, n: int, day: Column) -> Column:
        row = lambda i: F.struct(F.lit(kind).alias("kind"), day.alias("start_day"), i.alias("entity_id"))
        return F.transform(picked(kind, n, day), row)

    all_days = F.sequence(F.lit(0).cast("bigint"), F.col("last") - 1)
    return one.select(F.explode(F.flatten(F.transform(all_days, lambda d: F.flatten(F.array(*[rows_of(k, n, d) for k, n in wanted.items()]))))).alias("p")).select("p.*")


def share_cutoffs(
    rows: DataFrame,
    group_col: str,
    id_col: str,
    divisor: int,
    id_mult: int = ID_MULT,
    group_mult: int = DAY_MULT,
    modulus: int = ROW_MODULUS,
) -> DataFrame:
    """F5 as a per-group cutoff: ``(group, h_cut, id_cut)`` such that the
    group keeps exactly the rows with ``(h, id) <= (h_cut, id_cut)``, where
    ``h = (id * id_mult + group * group_mult) % modulus`` -- i.e. the
    ``floor(size / divisor)`` smallest. Groups keeping nothing are absent.
    One row per group, so it can be broadcast and applied row by row.
    Only the rows of each group's boundary hash bucket are ever ordered; the
    table of boundaries is stored, so it is broadcast by its size in bytes."""
    h = day_hash(F.col(id_col), F.col(group_col), modulus, id_mult, group_mult)
    tagged = rows.select(group_col, id_col).withColumn("h", h)
    hist = tagged.groupBy(group_col, "h").agg(F.count("*").alias("c"))
    run = Window.partitionBy(group_col).orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(group_col)
    boundary = (
        hist.withColumn("upto", F.sum("c").over(run))
        .withColumn("quota", F.floor(F.sum("c").over(whole) / F.lit(divisor)))
        .where((F.col("quota") > 0) & (F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("c") < F.col("quota")))
        .select(F.col(group_col).alias("_g"), F.col("h").alias("h_cut"), (F.col("quota") - (F.col("upto") - F.col("c"))).alias("take"))
    )
    boundary = stored(boundary, "boundaries")
    in_bucket = Window.partitionBy(group_col).orderBy(id_col)
    return (
        tagged.join(boundary, (F.col(group_col) == F.col("_g")) & (F.col("h") == F.col("h_cut")))
        .select(group_col, "h_cut", "take", id_col)
        .withColumn("rb", F.row_number().over(in_bucket))
        .where(F.col("rb") == F.col("take"))
        .select(group_col, "h_cut", F.col(id_col).alias("id_cut"))
    )


def smallest_share_per_group(
    rows: DataFrame,
    group_col: str,
    id_col: str,
    divisor: int,
    id_mult: int = ID_MULT,
    group_mult: int = DAY_MULT,
    modulus: int = ROW_MODULUS,
) -> DataFrame:
    """per group keep the ``floor(size / divisor)`` rows smallest by
    ``((id * id_mult + group * group_mult) % modulus, id)``.

    Exact without sorting a whole group in one task: a histogram of hash
    values per group (partial aggregation) gives, by a running sum over at
    most ``modulus`` buckets, how many rows each bucket keeps; only rows of
    one (group, hash) bucket are ever ordered together.
    """
    h = day_hash(F.col(id_col), F.col(group_col), modulus, id_mult, group_mult)
    tagged = rows.select(group_col, id_col).withColumn("h", h)
    hist = tagged.groupBy(group_col, "h").agg(F.count("*").alias("c"))
    run = Window.partitionBy(group_col).orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(group_col)
    keep = (
        hist.withColumn("before", F.sum("c").over(run) - F.col("c"))
        .withColumn("quota", F.floor(F.sum("c").over(whole) / F.lit(divisor)))
        .withColumn("take", F.least(F.col("c"), F.greatest(F.lit(0), F.col("quota") - F.col("before"))))
        .where(F.col("take") > 0)
        .select(group_col, "h", "take")
    )
    in_bucket = Window.partitionBy(group_col, "h").orderBy(id_col)
    return (
        tagged.join(keep, [group_col, "h"])
        .withColumn("rb", F.row_number().over(in_bucket))
        .where(F.col("rb") <= F.col("take"))
        .select(group_col, id_col)
    )
