"""Session helpers for tests, the benchmark and local runs.

Library operators never create sessions; the caller passes one in.  ``local_session`` is for
tests and ``bench.py`` only.  ``shared_dir`` resolves the folder that the session names in
``spark.checkpoint.dir`` (tests and ``bench.py`` set it; on a cluster it must be shared storage).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "framewright",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder: the context's, or else the one the session names in
    ``spark.checkpoint.dir``.  Where neither is set, a local master (tests, one machine) gets a folder
    of its own; a cluster has to name one that all its machines share."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints and streaming "
                               "results must be readable from every machine of the cluster")
        configured = f"/tmp/checkpoints/framewright-{uuid.uuid4().hex[:12]}"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run of one job."""
    root = checkpoint_root(spark)
    path = os.path.join(root, f"{purpose}-{uuid.uuid4().hex[:12]}")
    return path


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote under the shared checkpoint folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
