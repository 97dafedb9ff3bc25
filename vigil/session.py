"""Session helpers.

Library code never sets the master. ``local_session`` is for tests and the bench only.
``shared_dir`` names the folder for intermediate data: the cluster's ``spark.checkpoint.dir``, else (local masters
only) a folder under the session's warehouse.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vigil") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("VIGIL_DRIVER_MEMORY", "8g"))
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session as it is set.

    Unset on a local master (tests, single machine): a folder under the warehouse, which is then set as the
    context's checkpoint directory. Unset on a cluster: the warehouse serves only if it is not on a ``file:`` system, else an error --
    a machine-local folder would lose data.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_vigil_checkpoints"
        path = sc._jvm.org.apache.hadoop.fs.Path(d)
        fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if fs.getScheme() == "file" and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = fs.makeQualified(path).toString()
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared dir, inside one folder per application that goes when the application ends."""
    sc = spark.sparkContext
    run = f"{shared_dir(spark)}/vigil-scratch-{sc.applicationId}"
    path = sc._jvm.org.apache.hadoop.fs.Path(run)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(path)
    return f"{run}/{name}-{uuid.uuid4().hex[:12]}"
