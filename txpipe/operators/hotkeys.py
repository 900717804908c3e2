"""Rolling features for hot customers (skew-safe W1-W12).

The plain plan partitions every window by customer, so one customer with a
third of all rows would be one task, and a RANGE frame rescans its frame
for every row. Every customer above a row threshold -- the rows without a
customer count as one, too -- takes this plan instead. Its time is cut into
blocks whose length divides one day and holds about ``rows_per_block`` rows
where the customer's rows are densest (measured by minute, so a burst gets
short blocks whatever the span of the rest). The frame of a row at time ``t``
in block ``b`` is then exactly

    [t - n days, t] = suffix of block b - m  (from t - n days)
                    + blocks b - m + 1 .. b - 1
                    + prefix of block b      (up to t, peers included)

with ``m = n days / block length``. Every row is emitted once for its own
block and once, shifted by n days, into block ``b + m`` for each span n
(four copies). After one exchange on (customer, block), running windows
give the prefix (ascending order) and the three edge suffixes (descending
order) in O(1) per row. The whole blocks in between are the same question one
level up: the table of blocks (only those that have rows) is cut into coarser
spans that divide a day, and these into days, and at each level a prefix, a
suffix and whatever lies between come from running windows by (customer, span).
At the top a customer has a row a day, and the window slides over 30 of them at
most. So no window holds more than ``4 * SPAN_BLOCKS`` rows of these tables,
however many blocks a customer has; the same holds for a customer's pairs with
one terminal. Rows without a time see only each other; they take one aggregate.
Amounts are summed as integers in units of the exact scale, the same sums the
decimal form gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txpipe import schema as S
from txpipe.session import stored

DAY_US = 86_400_000_000
MINUTE_US = 60_000_000
# Block lengths that divide one day: 1 day .. 1 ms.
BLOCK_US = [DAY_US // q for q in (1, 2, 3, 4, 6, 8, 12, 24, 48, 96, 288, 1440, 2880, 8640, 86400, 864000, 8640000, 86400000)]
SPANS = S.WINDOW_DAYS
NULL_KEY = -(2**63)  # stands for no customer, or no terminal
# Blocks up to a 10 s length go straight into days; shorter ones into spans of
# 5 min, 30 s or 10 s first.
SPAN_US = {DAY_US // 86400: DAY_US // 288, DAY_US // 864000: DAY_US // 288, DAY_US // 8640000: DAY_US // 2880, DAY_US // 86400000: DAY_US // 8640}
SPAN_BLOCKS = 10_000  # most blocks in a span, and most spans in a day
UNIT = 10**S.AMOUNT_SCALE

K, T, ID, AMT, TS = "CUSTOMER_ID", "TERMINAL_ID", "TRANSACTION_ID", "TX_AMOUNT", "TX_DATETIME"


def _key():
    return F.coalesce(F.col(K), F.lit(NULL_KEY))


def find_hot_keys(tx: DataFrame, min_rows: int = 20_000, rows_per_block: int = 1_000_000) -> DataFrame | None:
    """``(_k, _blk)`` of every customer with more than ``min_rows`` rows, or None
    if there is none: ``_blk`` is the block length in microseconds. At most rows
    / ``min_rows`` keys, stored, so joins with it broadcast by its bytes or
    shuffle. Runs jobs: the answer decides the plan."""
    many = stored(tx.groupBy(_key().alias("_k")).agg(F.count("*").alias("n")).where(F.col("n") > F.lit(min_rows)), "hot-keys")
    if many.isEmpty():
        return None
    minute = F.floor(F.unix_micros(F.col(TS)) / F.lit(MINUTE_US))
    per_minute = tx.withColumn("_k", _key()).join(many, "_k").where(F.col(TS).isNotNull()).groupBy("_k", minute.alias("minute")).agg(F.count("*").alias("c"))
    densest = many.join(per_minute.groupBy("_k").agg(F.max("c").alias("c")), "_k", "left")
    raw = F.lit(float(rows_per_block) * MINUTE_US) / F.coalesce("c", F.lit(1))
    blk = F.lit(BLOCK_US[-1])
    for b in reversed(BLOCK_US[:-1]):
        blk = F.when(raw >= F.lit(b), F.lit(b)).otherwise(blk)
    return stored(densest.select("_k", blk.cast("bigint").alias("_blk")), "hot-blocks")


def mark_hot(tx: DataFrame, hot: DataFrame) -> DataFrame:
    """``tx`` with ``_k``, ``_blk`` (NULL: not hot)."""
    return tx.withColumn("_k", _key()).join(hot, "_k", "left")


def _span(blk):
    """The coarser span of a block length."""
    out = F.lit(DAY_US)
    for short, span in SPAN_US.items():
        out = F.when(blk == F.lit(short), F.lit(span)).otherwise(out)
    return out.cast("bigint")


def between(buckets: DataFrame, keys: list[str], measures: dict, lengths: tuple[str, ...] = ("_blk", "_span", "_day")) -> DataFrame:
    """For each bucket ``b`` of the first length, and each span of n days, the
    measures over buckets b - m + 1 .. b - 1 of the same keys (m = n days / length)
    as ``<measure>_<n>``; NULL where there are none. ``measures`` maps names to
    ``F.sum`` or ``F.max``; ``lengths`` are columns of microseconds, each a multiple
    of the one before, the last a day."""
    names = [f"{m}_{n}" for m in measures for n in SPANS]
    if len(lengths) == 1:
        days = lambda n: Window.partitionBy(*keys).orderBy("b").rangeBetween(-(n - 1), -1)
        found = [(agg(m).over(days(n)) if n > 1 else agg(F.when(F.lit(False), F.col(m))).over(days(2))).alias(f"{m}_{n}") for m, agg in measures.items() for n in SPANS]
        return buckets.select(*keys, "b", *found)
    placed = buckets.withColumn("_per", F.expr(f"{lengths[1]} div {lengths[0]}")).withColumn("_pos", F.pmod("b", "_per"))
    placed = placed.withColumn("_s", F.expr("(b - _pos) div _per"))
    spans = placed.groupBy(*keys, *lengths[1:], F.col("_s").alias("b")).agg(*[agg(m).alias(m) for m, agg in measures.items()])
    above = between(spans, keys, measures, lengths[1:]).select(*keys, F.col("b").alias("_s"), *[F.col(c).alias(f"_up_{c}") for c in names])
    # A span's own buckets, and those of the span n days before, in its place.
    rows = placed.withColumn("n", F.explode(F.array(F.lit(0), *map(F.lit, SPANS)))).withColumn("_s", F.expr(f"_s + n * {DAY_US} div {lengths[1]}"))
    ahead = lambda order: Window.partitionBy(*keys, "_s").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    own = lambda m, agg: agg(F.when(F.col("n") == 0, F.col(m))).over(ahead(F.col("_pos")))
    edge = lambda m, agg, n: agg(F.when(F.col("n") == n, F.col(m))).over(ahead(F.col("_pos").desc()))
    rows = rows.withColumns({f"_own_{m}": own(m, agg) for m, agg in measures.items()} | {f"_edge_{m}_{n}": edge(m, agg, n) for m, agg in measures.items() for n in SPANS})
    rows = rows.where(F.col("n") == 0).join(above, [*keys, "_s"], "left")

    def whole(m, agg, n):
        parts = [F.col(f"_own_{m}"), F.col(f"_up_{m}_{n}"), F.col(f"_edge_{m}_{n}")]
        return F.greatest(*parts) if agg is F.max else sum((F.coalesce(p, F.lit(0)) for p in parts), F.lit(0).cast("bigint"))

    return rows.select(*keys, "b", *[whole(m, agg, n).alias(f"{m}_{n}") for m, agg in measures.items() for n in SPANS])


def _timeless(rows: DataFrame, base_cols: list[str], specs: list[S.RollingSpec]) -> DataFrame:
    """Rows without a time are each other's peers: one aggregate per key."""
    units = F.sum(F.expr(_exact()))
    per_key = rows.groupBy("_k").agg(F.count(ID).alias("n"), F.count(AMT).alias("na"), units.alias("u"), F.max(AMT).alias("mx"))
    per_pair = rows.groupBy("_k", "_t").agg(F.count(ID).alias("np"))
    out = rows.join(per_key, "_k").join(per_pair, ["_k", "_t"])
    values = {
        "avg": F.col("u").cast("double") / F.when(F.col("na") > 0, F.col("na")),
        "max": F.col("mx"),
    }
    pick = lambda s: values.get(s.agg, F.col("n") if len(s.keys) == 1 else F.col("np"))
    return out.select(*base_cols, *[pick(s).alias(s.name) for s in specs])


def _exact() -> str:
    from txpipe.operators.features import exact_amount

    return exact_amount(AMT)


def hot_rolling(marked: DataFrame, base_cols: list[str], specs: list[S.RollingSpec]) -> DataFrame:
    """W1-W12 for the marked rows of hot customers, same columns and values as
    :func:`txpipe.operators.features.add_rolling`."""
    u = F.unix_micros(F.col(TS))
    tagged = marked.withColumn("_t", F.coalesce(F.col(T), F.lit(NULL_KEY)))
    timeless = _timeless(tagged.where(F.col(TS).isNull()), base_cols, specs)
    r = (
        tagged.where(F.col(TS).isNotNull())
        .withColumn("_u", u)
        .withColumn("_b", F.floor(F.col("_u") / F.col("_blk")).cast("bigint"))
        .withColumn("_c", (F.expr(_exact()) * F.lit(UNIT)).cast("bigint"))
    )

    # Per-block tables, by customer and by pair, and what lies between.
    r = r.withColumns({"_span": _span(F.col("_blk")), "_day": F.lit(DAY_US).cast("bigint")})
    lengths = ["_blk", "_span", "_day"]
    blocks = r.groupBy("_k", *lengths, F.col("_b").alias("b")).agg(
        F.count(ID).alias("mc_cnt"), F.count(AMT).alias("mc_cnta"), F.sum("_c").alias("mc_sum"), F.max(AMT).alias("mc_max")
    )
    mid_c = between(blocks, ["_k"], {"mc_cnt": F.sum, "mc_cnta": F.sum, "mc_sum": F.sum, "mc_max": F.max})
    pblocks = r.groupBy("_k", "_t", *lengths, F.col("_b").alias("b")).agg(F.count(ID).alias("mp_cnt"))
    mid_p = between(pblocks, ["_k", "_t"], {"mp_cnt": F.sum}).withColumnRenamed("b", "pb")

    # Own copy plus one shifted copy per span into the block whose left edge it is.
    copies = [F.struct(F.lit(0).alias("role"), F.col("_b").alias("pb"), F.col("_u").alias("v"))]
    for n in SPANS:
        shift_blocks = F.lit(n * DAY_US) / F.col("_blk")
        copies.append(
            F.struct(
                F.lit(n).alias("role"),
                (F.col("_b") + shift_blocks.cast("bigint")).alias("pb"),
                (F.col("_u") + F.lit(n * DAY_US)).alias("v"),
            )
        )
    keep = [*base_cols, "_k", "_t", "_c"]
    x = r.select(*keep, F.explode(F.array(*copies)).alias("cp")).select(*keep, "cp.role", "cp.pb", "cp.v")

    own = F.col("role") == 0
    upto = lambda *keys, order: Window.partitionBy("_k", "pb", *keys).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    asc, desc = upto(order=F.col("v")), upto(order=F.col("v").desc())
    asc_p, desc_p = upto("_t", order=F.col("v")), upto("_t", order=F.col("v").desc())

    def only(cond, c):
        return F.when(cond, F.col(c))

    aggs = [
        F.count(only(own, ID)).over(asc).alias("o_cnt"),
        F.count(only(own, AMT)).over(asc).alias("o_cnta"),
        F.sum(only(own, "_c")).over(asc).alias("o_sum"),
        F.max(only(own, AMT)).over(asc).alias("o_max"),
        F.count(only(own, ID)).over(asc_p).alias("o_pcnt"),
    ]
    for n in SPANS:
        e = F.col("role") == n
        aggs += [
            F.count(only(e, ID)).over(desc).alias(f"e_cnt_{n}"),
            F.count(only(e, AMT)).over(desc).alias(f"e_cnta_{n}"),
            F.sum(only(e, "_c")).over(desc).alias(f"e_sum_{n}"),
            F.max(only(e, AMT)).over(desc).alias(f"e_max_{n}"),
            F.count(only(e, ID)).over(desc_p).alias(f"e_pcnt_{n}"),
        ]
    windowed = x.select("*", *aggs).where(own)

    # The pair counts join on (customer, block, terminal): one more exchange
    # of the hot rows, but each row meets exactly one pair row.
    joined = windowed.join(mid_c.withColumnRenamed("b", "pb"), ["_k", "pb"], "left").join(mid_p, ["_k", "pb", "_t"], "left")

    def z(c):
        return F.coalesce(F.col(c), F.lit(0))

    out = []
    for spec in specs:
        n = spec.days
        if spec.agg == "count" and len(spec.keys) == 1:
            val = z("o_cnt") + z(f"mc_cnt_{n}") + z(f"e_cnt_{n}")
        elif spec.agg == "count":
            val = z("o_pcnt") + z(f"mp_cnt_{n}") + z(f"e_pcnt_{n}")
        elif spec.agg == "max":
            val = F.greatest("o_max", f"mc_max_{n}", f"e_max_{n}")
        else:
            total = z("o_sum") + z(f"mc_sum_{n}") + z(f"e_sum_{n}")
            cnt = z("o_cnta") + z(f"mc_cnta_{n}") + z(f"e_cnta_{n}")
            one = F.lit(1).cast("decimal(20,0)") / F.lit(UNIT).cast(f"decimal({S.AMOUNT_SCALE + 1},0)")
            amount = (total.cast("decimal(20,0)") * one.cast(f"decimal({S.AMOUNT_SCALE + 1},{S.AMOUNT_SCALE})")).cast("double")
            val = amount / F.when(cnt > 0, cnt.cast("double"))
        out.append(val.alias(spec.name))
    return joined.select(*base_cols, *out).unionByName(timeless)
