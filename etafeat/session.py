"""SparkSession helpers.

The library never creates a session implicitly; jobs pass one in. These helpers
exist for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall-clock for timestamp arithmetic, AQE for
# runtime re-planning (coalescing, skew splits, broadcast conversion).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "etafeat", extra: dict | None = None,
                  driver_memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(CORE_CONF)
    conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir``; a scratch folder of our own
    will do only where driver and executors are one process (local tests).
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="etafeat-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    A stage boundary: later stages re-read only the columns they need, and a
    lost executor costs a re-read, not a recomputation of the whole lineage.
    """
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/etafeat/{name}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
