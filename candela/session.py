"""Spark session conventions shared by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Execution settings read from the session (``spark.candela.*``). Defaults suit a cluster; tests lower
# ``blockRows`` so that every multi-block code path runs on small data.
BLOCK_ROWS_KEY = "spark.candela.blockRows"
BUCKET_SECONDS_KEY = "spark.candela.bucketSeconds"
SPLITS_KEY = "spark.candela.rankSplits"
MATERIALIZE_KEY = "spark.candela.materialize"


def get_spark(master: str | None = None, app: str = "candela", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Session with UTC time, AQE (coalescing and skew join) and no web UI."""
    master = master or os.environ.get("CANDELA_MASTER", "local[8]")
    cores = 8
    if master.startswith("local[") and master[6:-1].isdigit():
        cores = int(master[6:-1])
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CANDELA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only when the session names none.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage and is always respected.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = tempfile.mkdtemp(prefix="candela-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df):
    """Store a frame that feeds more than one branch (reliable checkpoint in the shared folder).

    Without it every branch of a self-join re-runs the whole upstream plan (column pruning makes the
    branches differ, so no exchange is reused), and chained scans multiply that work.
    ``spark.candela.materialize=false`` turns it off.
    """
    if df.sparkSession.conf.get(MATERIALIZE_KEY, "true").lower() == "false":
        return df
    return cut_lineage(df)


def setting(spark: SparkSession, key: str, default) -> int:
    return int(spark.conf.get(key, str(default)))
