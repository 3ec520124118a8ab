"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest number of rows we are willing to ship to every executor.
DEFAULT_BROADCAST_ROWS = 1_000_000


def get_session(master: str | None = None, app: str = "cohortlab",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew handling switched on.

    On a cluster ``master`` stays ``None`` and the launcher decides. Local
    runs (tests, bench) pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder below the shared checkpoint location.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    from the session. Only when it is unset (local tests) do we create our
    own, which the context then keeps, so every later call agrees.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="cohortlab-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    sub = f"{name}-{uuid.uuid4().hex[:12]}" if name else uuid.uuid4().hex  # never shared between runs
    return os.path.join(base.rstrip("/"), sub) if "://" not in base else base.rstrip("/") + "/" + sub


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    scratch_dir(df.sparkSession, "_init")  # ensures a checkpoint dir is set
    return df.checkpoint(eager=True)


def fits_in_rows(df: DataFrame, max_rows: int) -> bool:
    """Cheap proof of a size bound: count at most ``max_rows + 1`` rows."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when it is proven to hold at most ``max_rows``.

    Beyond the bound the frame is returned unchanged and the join falls back
    to a shuffle join (AQE may still convert it at run time).
    """
    return F.broadcast(df) if fits_in_rows(df, max_rows) else df
