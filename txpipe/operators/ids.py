"""Dense row ids in a global order (T6), and places inside groups (T3), without
a window over rows.

Rows are range-partitioned on the order key into an explicit number of
partitions (AQE does not coalesce those, so partition indexes are stable),
sorted inside each partition by a unique key, and written to the shared
folder with ``monotonically_increasing_id``, which numbers rows inside a
partition and carries the partition index. Both passes read that table, so the
sort runs once, nothing stays cached, and a lost executor costs only its own
tasks. A per-partition count (one row per partition) is prefix-summed, and
each row's id is the offset of its partition plus its rank inside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txpipe.session import stored

_LOW_BITS = 33  # monotonically_increasing_id keeps the row number in 33 bits


def default_partitions(df: DataFrame) -> int:
    """At least the shuffle setting, and no fewer than the input's own splits,
    which follow its bytes."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


def _tagged(df: DataFrame, order_cols: list[str], partitions: int | None, name: str) -> DataFrame:
    """The rows in order, stored with their number inside their partition."""
    ranged = df.repartitionByRange(partitions or default_partitions(df), *order_cols)
    return stored(ranged.sortWithinPartitions(*order_cols).withColumn("_mono", F.monotonically_increasing_id()), name)


def dense_id(df: DataFrame, order_cols: list[str], id_col: str = "dense_id", partitions: int | None = None) -> DataFrame:
    """``id_col`` = 0, 1, 2, ... in ``order_cols`` order (must be unique)."""
    tagged = _tagged(df, order_cols, partitions, "dense-ids")
    part = F.shiftright(F.col("_mono"), _LOW_BITS)
    counts = tagged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition: the prefix sum runs over a table bounded by the
    # partition count, not by the data.
    offsets = stored(counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset")), "offsets")
    low = F.col("_mono").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return (
        tagged.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(id_col, (F.col("_offset") + low).cast("bigint"))
        .drop("_part", "_offset", "_mono")
    )


def place_in_group(df: DataFrame, group_cols: list[str], order_cols: list[str], place_col: str = "place", partitions: int | None = None) -> DataFrame:
    """``place_col`` = 1, 2, 3, ... in ``order_cols`` order inside each group
    (NULLs are a group). A group may span any number of tasks: it is one run of
    consecutive rows in each partition that holds some of it, so a table of runs
    (at most groups + partitions rows) carries how many of the group's rows lie in
    partitions before, and a row's place is that plus its own place in the run.
    With ``order_cols`` unique inside a group, no group is tied to one task."""
    tagged = _tagged(df, [*group_cols, *order_cols], partitions, "places").withColumn("_part", F.shiftright(F.col("_mono"), _LOW_BITS))
    groups = [f"_g{i}" for i in range(len(group_cols))]
    runs = tagged.groupBy(*[F.col(c).alias(g) for c, g in zip(group_cols, groups, strict=True)], F.col("_part").alias("_p"))
    runs = runs.agg(F.min("_mono").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n"), "runs")
    same = F.col("_part") == F.col("_p")
    for c, g in zip(group_cols, groups, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(g))
    place = F.col("_before") + F.col("_mono") - F.col("_first") + 1
    return tagged.join(runs, same).withColumn(place_col, place.cast("bigint")).drop("_part", "_p", "_mono", "_first", "_before", *groups)
