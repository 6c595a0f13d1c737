"""Session helpers: building a session for tests/bench and finding the shared
checkpoint folder.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
system such as HDFS or an object store). Only when that setting is absent, as
in unit tests on ``local[*]``, do we create a scratch folder of our own.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "syncledger") -> SparkSession:
    """Session used by tests and the bench. Production callers bring their own."""
    return (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. If the cluster names none
    (tests, local runs), a scratch folder is created once per SparkContext.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    key = sc.applicationId
    if key not in _LOCAL_DIRS:
        _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="run-syncledger-")
        sc.setCheckpointDir(_LOCAL_DIRS[key])
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return "/".join([checkpoint_dir(spark), "syncledger", *parts])
