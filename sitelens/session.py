"""Session construction and cluster-safe checkpoint handling."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "sitelens", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives you instead."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of garbage-collected datasets (finished BFS levels) are removed
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Where nothing is configured, a local master (driver and executors are one process, as in tests)
    gets a fresh folder of its own; on a cluster that is an error, because a folder of one machine is
    not there for the others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not re.match(r"local(\[|$)", sc.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="sitelens-ckpt-", dir=os.environ.get("SITELENS_SCRATCH", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def store(df, name: str):
    """Write ``df`` as Parquet below the shared folder and read it back: lineage is cut, columns stay apart."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
