"""Aggregates, top-k, histogram, sample and correlation.

All are single hash aggregates (partial aggregation before the shuffle) or
TakeOrderedAndProject; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txpipe.functions.columns import date_from_offset, rounded_ratio
from txpipe.operators.picks import residue
from txpipe import schema as S

DAY = "TX_TIME_DAYS"


def daily_stats(df: DataFrame, start_date: str = "2018-04-01") -> DataFrame:
    """A1-A3 + P12 (A5): transactions, frauds and distinct defrauded cards
    per day, and the calendar date of the day. Days without fraud get 0
    defrauded cards (the reference leaves NaN, Q11)."""
    fraud = F.col("TX_FRAUD") == 1
    return df.groupBy(DAY).agg(
        F.count("CUSTOMER_ID").alias("nb_tx_per_day"),
        F.sum("TX_FRAUD").cast("bigint").alias("nb_fraudulent_transactions_per_day"),
        F.count_distinct(F.when(fraud, F.col("CUSTOMER_ID"))).alias("nb_frauded_cards_per_day"),
    ).withColumn("tx_date", date_from_offset(DAY, start_date))


def tx_per_day(df: DataFrame) -> DataFrame:
    """A1: transactions (non-null customer) per day."""
    return df.groupBy(DAY).agg(F.count("CUSTOMER_ID").alias("nb_tx_per_day"))


def frauds_per_day(df: DataFrame) -> DataFrame:
    """A2: sum of the fraud flag per day."""
    return df.groupBy(DAY).agg(F.sum("TX_FRAUD").cast("bigint").alias("nb_fraudulent_transactions_per_day"))


def frauded_cards_per_day(df: DataFrame) -> DataFrame:
    """A3: distinct customers with a fraud, per day (days with fraud only)."""
    return (
        df.where(F.col("TX_FRAUD") == 1)
        .groupBy(DAY)
        .agg(F.count_distinct("CUSTOMER_ID").alias("nb_frauded_cards_per_day"))
    )


def scaled_daily(stats: DataFrame, divisor: float = 50.0) -> DataFrame:
    """A measure scaled for display (transactions per day / 50)."""
    return stats.select(DAY, (F.col("nb_tx_per_day") / F.lit(float(divisor))).alias("nb_tx_per_day_scaled"))


def max_amount_per_customer(df: DataFrame) -> DataFrame:
    """A4."""
    return df.groupBy("CUSTOMER_ID").agg(F.max("TX_AMOUNT").alias("max_amount"))


def top_customers_by_max_amount(df: DataFrame, k: int = 20) -> DataFrame:
    """T4: top ``k`` customers by maximum amount (customer id breaks ties);
    planned as TakeOrderedAndProject, a per-partition top-k then one merge
    of at most k rows per partition."""
    return max_amount_per_customer(df).orderBy(F.col("max_amount").desc(), F.col("CUSTOMER_ID").asc()).limit(k)


def hourly_counts(df: DataFrame, ts: str = "TX_DATETIME", prediction: str = "prediction") -> DataFrame:
    """A6/A7/R4 (batch form): per tumbling hour the transactions / 30 and
    conditional counts of frauds, correct fraud predictions and false
    positives. Window struct flattened to ``window_start``/``window_end``."""
    fraud, pred = F.col("TX_FRAUD"), F.col(prediction)
    return (
        df.groupBy(F.window(F.col(ts).cast("timestamp"), "1 hour", "1 hour").alias("window"))
        .agg(*hourly_measures(fraud, pred))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "nx_transactions",
            "nx_fraud_transactions",
            "correct_fraud_predictions",
            "false_positive_predictions",
        )
    )


def hourly_measures(fraud: Column, pred: Column) -> list[Column]:
    return [
        rounded_ratio(F.count("CUSTOMER_ID"), S.HOURLY_COUNT_DIVISOR, 2).alias("nx_transactions"),
        F.count_if(fraud == 1).alias("nx_fraud_transactions"),
        F.count_if((fraud == 1) & (pred == 1)).alias("correct_fraud_predictions"),
        F.count_if((fraud == 0) & (pred == 1)).alias("false_positive_predictions"),
    ]


def total_fraud(df: DataFrame) -> DataFrame:
    """A8."""
    return df.agg(F.sum("TX_FRAUD").cast("bigint").alias("total_fraud"))


def max_day(df: DataFrame) -> DataFrame:
    """A9."""
    return df.agg(F.max(DAY).alias("max_day"))


def correlation_long(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """A10: Pearson correlation of every pair (a <= b in list order) over
    pairwise-complete rows, long ``(col_a, col_b, corr)``; undefined -> NULL.

    One pass over the data. A task centres each Arrow batch on its column
    means; with X the centred values (NULL -> 0) and M the non-NULL mask, the
    k x k products M'M, X'M, (X*X)'M and X'X give every pair's count, means and
    co-moments over the rows where both values exist. Moments of batches, and
    then the one row per pair and task, are merged pairwise: the co-moment of
    two parts is the sum of theirs plus ``n1 n2 / (n1 + n2)`` times the product
    of the differences of their means. A pair's group holds a row per task.
    """
    k = len(columns)
    x = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    iu, ju = _upper_pairs(k)
    names = ["n", "mean_a", "mean_b", "caa", "cbb", "cab"]

    def task_moments(batches):
        import numpy as np
        import pandas as pd

        total = np.zeros((6, len(iu)))
        for pdf in batches:
            vals = pdf.to_numpy(dtype="float64", na_value=np.nan)
            mask = ~np.isnan(vals)
            shift = np.where(mask, vals, 0.0).sum(axis=0) / np.maximum(mask.sum(axis=0), 1)
            xs = np.where(mask, vals - shift, 0.0)
            m = mask.astype("float64")
            n = (m.T @ m)[iu, ju]
            at_least_1 = np.maximum(n, 1.0)
            sa, sb = (xs.T @ m)[iu, ju], (xs.T @ m)[ju, iu]
            caa = ((xs * xs).T @ m)[iu, ju] - sa * sa / at_least_1
            cbb = ((xs * xs).T @ m)[ju, iu] - sb * sb / at_least_1
            cab = (xs.T @ xs)[iu, ju] - sa * sb / at_least_1
            part = np.stack([n, shift[iu] + sa / at_least_1, shift[ju] + sb / at_least_1, caa, cbb, cab])
            total = _merged_moments(total, part)
        keep = total[0] > 0
        yield pd.DataFrame({"pair": np.arange(len(iu), dtype="int32")[keep], **dict(zip(names, total[:, keep]))})

    parts = x.mapInPandas(task_moments, "pair int, " + ", ".join(f"{c} double" for c in names))
    zero = F.struct(*[F.lit(0.0).alias(c) for c in names])

    def merge(s, p):
        n = s["n"] + p["n"]
        da, db, w = p["mean_a"] - s["mean_a"], p["mean_b"] - s["mean_b"], s["n"] * p["n"] / n
        return F.struct(
            n.alias("n"),
            (s["mean_a"] + da * p["n"] / n).alias("mean_a"),
            (s["mean_b"] + db * p["n"] / n).alias("mean_b"),
            (s["caa"] + p["caa"] + w * da * da).alias("caa"),
            (s["cbb"] + p["cbb"] + w * db * db).alias("cbb"),
            (s["cab"] + p["cab"] + w * da * db).alias("cab"),
        )

    merged = parts.groupBy("pair").agg(F.aggregate(F.collect_list(F.struct(*names)), zero, merge).alias("s")).select("pair", "s.*")
    caa, cbb = F.col("caa"), F.col("cbb")
    r = F.when((F.col("n") > 1) & (caa > 0) & (cbb > 0), F.col("cab") / F.sqrt(caa * cbb))
    r = F.when(r.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r)))
    names_a = F.array(*[F.lit(columns[i]) for i in iu])
    names_b = F.array(*[F.lit(columns[j]) for j in ju])
    pairs = df.sparkSession.range(len(iu)).select(
        F.col("id").cast("int").alias("pair"),
        F.element_at(names_a, F.col("id").cast("int") + 1).alias("col_a"),
        F.element_at(names_b, F.col("id").cast("int") + 1).alias("col_b"),
    )
    return pairs.join(merged, "pair", "left").select("col_a", "col_b", F.round(r, digits).alias("corr"))


def _merged_moments(s, p):
    """Moments (n, means, co-moments) of two parts' rows together."""
    import numpy as np

    n = np.maximum(s[0] + p[0], 1.0)
    da, db, w = p[1] - s[1], p[2] - s[2], s[0] * p[0] / n
    share = p[0] / n
    return np.stack([s[0] + p[0], s[1] + da * share, s[2] + db * share, s[3] + p[3] + w * da * da, s[4] + p[4] + w * db * db, s[5] + p[5] + w * da * db])


def _upper_pairs(k: int):
    import numpy as np

    return np.triu_indices(k)


def amount_histogram(df: DataFrame, bins: int = 50, col: str = "TX_AMOUNT") -> DataFrame:
    """Equal-width histogram between min and max (last bin closed); both
    bounds come from one scalar subquery -- no driver round trip."""
    bounds = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = hi - lo
    x = F.col(col)
    raw = F.floor((x - lo) / width * F.lit(float(bins)))
    bucket = F.when(width == 0, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    counted = df.where(x.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return counted.select(
        "bucket",
        (lo + width * F.col("bucket") / F.lit(float(bins))).alias("lower"),
        (lo + width * (F.col("bucket") + 1) / F.lit(float(bins))).alias("upper"),
        "n",
    )


def hash_sample(df: DataFrame, n: int, id_col: str = "TRANSACTION_ID", modulus: int = 1000003, mult: int = 7919) -> DataFrame:
    """An exact-size pseudo-random sample: the ``n`` rows smallest by
    ``((id * mult) % modulus, id)``.

    No global sort and no single-task top-n of ``n x partitions`` rows: a
    histogram of the hash (partial aggregation, at most ``modulus`` buckets)
    and a running sum over that bounded table give the cutoff bucket; rows
    below it pass a filter where they are, and only the cutoff bucket's
    rows are ordered by id."""
    if n <= 0:
        return df.where(F.lit(False))
    h = F.coalesce(residue(F.col(id_col), mult, modulus), F.lit(modulus))
    tagged = df.withColumn("_h", h)
    hist = tagged.groupBy("_h").agg(F.count("*").alias("_c"))
    # One row per hash value: bounded by ``modulus`` + 1 whatever the data size.
    run = Window.orderBy("_h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        hist.withColumn("_upto", F.sum("_c").over(run))
        .where((F.col("_upto") >= F.lit(n)) & (F.col("_upto") - F.col("_c") < F.lit(n)))
        .select(F.col("_h").alias("_hcut"), (F.lit(n) - (F.col("_upto") - F.col("_c"))).alias("_take"))
    )
    hcut = cut.select("_hcut").scalar()  # NULL when the table has <= n rows
    take = cut.select("_take").scalar()
    below = tagged.where(hcut.isNull() | (F.col("_h") < hcut))
    in_edge = Window.partitionBy("_h").orderBy(id_col)
    edge = (
        tagged.where(F.col("_h") == hcut)
        .withColumn("_r", F.row_number().over(in_edge))
        .where(F.col("_r") <= take)
        .drop("_r")
    )
    return below.unionByName(edge).drop("_h")
