"""Session helpers: a local session for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tierwise") -> SparkSession:
    """A ``local[cpus]`` session (tests and bench only; a cluster brings its own session)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIERWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    Uses the folder the cluster names (``spark.checkpoint.dir`` / an already set checkpoint dir).
    Only a local-mode session without one (tests, bench) gets a fresh ``/tmp`` folder; on a cluster
    a machine-local folder would not survive losing the executor, so it is an error instead."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tierwise-ckpt-", dir="/tmp"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared (distributed) folder")


def cut_lineage(df):
    """Reliable checkpoint (written to the shared checkpoint folder; survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
