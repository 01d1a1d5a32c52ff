"""Session construction and the shared scratch location.

Intermediate tables and checkpoints go to the folder named by
``spark.checkpoint.dir``: on a cluster that is a shared file system every
executor can reach. Only when it is unset (local runs, tests) do we pick a
fresh local folder ourselves.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Column pruning / filter pushdown into nested parquet scans.
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "routecast",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised layers.

    Read from ``spark.checkpoint.dir``. Where the session has none, a private
    local folder is made if the master is local (tests, single-machine runs);
    on a cluster every executor would write to its own disk, so that raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="routecast-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local
