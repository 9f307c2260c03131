"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster the work folder is the one the cluster names in
``spark.checkpoint.dir`` (a shared filesystem every executor can reach).
Only when that is unset *and* the master is local (tests, bench) do we fall
back to a fresh local scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "verlog") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VERLOG_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables and lineage cuts.

    Reads ``spark.checkpoint.dir`` from the session. Sets its own only when the
    setting is unset and the master is local; a cluster must name one.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a unique child; use its parent as the root.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a cluster run needs a shared folder "
            "for written tables (set spark.checkpoint.dir)"
        )
    local_dir = tempfile.mkdtemp(prefix="verlog-work-")
    sc.setCheckpointDir(local_dir)
    return local_dir
