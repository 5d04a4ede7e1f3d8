"""Session helpers: a local session for tests and folders for written intermediate tables.

On a cluster the session is built by the platform and names its shared folder in
``spark.checkpoint.dir``; ``scratch_path`` hands out folders below it. A machine-local
temporary folder is only ever used by a single-process ``local[...]`` session that names
none, as in tests: any other master without the setting is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(master: str = "local[8]", app: str = "driftgate", **conf: str) -> SparkSession:
    """Build (or reuse) a local session with the settings the tests assume."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where none is configured, a ``local[...]`` session
    (one process, one disk) gets a temporary one and any other master raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="driftgate-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "driftgate", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, and
    a lost executor costs a reread instead of a recompute."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_small(df: DataFrame) -> DataFrame:
    """Compute a small result once and cut its lineage with a reliable checkpoint in the
    shared checkpoint folder: later steps read a few rows instead of re-running (and
    re-planning) the scans behind them, and a lost executor cannot force a recompute."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
