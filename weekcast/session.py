"""Spark session helpers.

``get_session`` is for tests, the bench and local runs; on a cluster the
caller brings its own session.  ``shared_dir`` returns a folder under the
session's ``spark.checkpoint.dir`` (the shared folder a cluster names) and only
creates a local one when the session has none and runs in local mode.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.constraintPropagation.enabled": "false",  # planning time of the ~60-column feature plans
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "weekcast",
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set one only in local mode.

    Under Spark Connect there is no SparkContext on the client; the server's
    ``spark.checkpoint.dir`` setting is used as is."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect session
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="weekcast-ckpt-"))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder, for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read back, for a table that one plan reads many times."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
