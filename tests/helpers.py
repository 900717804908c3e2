from datetime import datetime

from pyspark.sql import types as T

TX_SCHEMA = T.StructType(
    [
        T.StructField("TRANSACTION_ID", T.LongType()),
        T.StructField("TX_DATETIME", T.TimestampType()),
        T.StructField("CUSTOMER_ID", T.LongType()),
        T.StructField("TERMINAL_ID", T.LongType()),
        T.StructField("TX_AMOUNT", T.DoubleType()),
        T.StructField("TX_TIME_SECONDS", T.LongType()),
        T.StructField("TX_TIME_DAYS", T.LongType()),
    ]
)

ORIGIN = datetime(2024, 1, 1)


def tx_rows(spark, rows):
    """rows: (id, datetime, customer, terminal, amount)."""
    out = []
    for i, ts, c, t, a in rows:
        secs = int((ts - ORIGIN).total_seconds() // 1)
        days = (ts.date() - ORIGIN.date()).days
        out.append((i, ts, c, t, a, secs, days))
    return spark.createDataFrame(out, TX_SCHEMA)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.count("Exchange hashpartitioning")


def streamed_path_nodes(df) -> list[str]:
    """Class names of the nodes on the probe (non-broadcast) side of every
    broadcast join, from the root to the scans, in the final plan."""
    df.collect()
    names: list[str] = []

    def children(node):
        seq = node.children()
        return [seq.apply(i) for i in range(seq.size())]

    def walk(node):
        cls = node.getClass().getSimpleName()
        names.append(cls)
        if cls == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if cls in ("ShuffleQueryStageExec", "ResultQueryStageExec", "TableCacheQueryStageExec"):
            return walk(node.plan())
        if cls in ("BroadcastQueryStageExec", "InMemoryTableScanExec"):
            return
        kids = children(node)
        if cls == "BroadcastHashJoinExec":
            build_right = "BuildRight" in node.buildSide().toString()
            return walk(kids[0] if build_right else kids[1])
        for k in kids:
            walk(k)

    walk(df._jdf.queryExecution().executedPlan())
    return names
