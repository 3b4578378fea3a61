"""Session helpers.

The library never creates global state: every operator takes the caller's
DataFrames.  ``local_session`` exists for tests and the bench script only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "vintagebook") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it there is no folder that all executors see, and this
    raises.  Only a local session gets a folder of its own when it is unset.
    Under Spark Connect there is no SparkContext; the server's setting is used.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect
        if not cur:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return cur
    if not cur:
        cur = sc.getCheckpointDir()
    if not cur:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="vintagebook-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", cur)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return cur


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def checkpointed(df):
    """``df.checkpoint()`` into the shared checkpoint folder (set from
    ``spark.checkpoint.dir`` when the context has none yet)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def task_slots(spark: SparkSession) -> int:
    """How many tasks the cluster runs at once (under Spark Connect, which does not
    say: the number of shuffle partitions)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - Spark Connect
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
