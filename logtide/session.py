"""Session helpers.

`local_session` is what tests and the bench use. Library code never builds a
session; it takes the caller's. `shared_dir` is the one place that decides
where intermediate files go: the folder the cluster names in
``spark.checkpoint.dir``. Only when that is unset on a local master (as
in tests) is a folder of our own made and registered; a cluster without one is
an error, since its machines share no other folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "logtide", conf: dict | None = None) -> SparkSession:
    """Local session for tests and the bench: UI off, AQE on, UTC, few shuffle partitions."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). If
    neither is set on a local master, creates one and registers it with the context, so later
    ``DataFrame.checkpoint()`` calls land in the same place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="logtide-ckpt-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never cleared)."""
    return f"{shared_dir(spark)}/logtide-scratch/{name}-{uuid.uuid4().hex[:12]}"
