"""Session helpers: time zone, shared work folders, stored side tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "txpipe") -> SparkSession:
    """Session for tests and the local benchmark (cluster jobs bring their own)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Timestamps in the data carry no zone; all calendar logic runs in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be given (a shared file system path). Only
    a local session without it gets a fresh folder under the system temp dir.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a shared folder for cluster runs")
    path = tempfile.mkdtemp(prefix="txpipe-ckpt-")
    spark.conf.set(_CHECKPOINT_KEY, path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder (not yet made; Spark's writers make it) of the shared
    checkpoint folder for stream sinks and tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/txpipe-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage, survives lost executors, leaves nothing cached, and gives
    the planner the table's size in bytes: a join broadcasts it exactly when it
    is below ``spark.sql.autoBroadcastJoinThreshold``, however many rows it has.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
