"""Session construction and the shared folder used for lineage cuts and models."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants; cluster-specific sizing (executor memory, shuffle
# partition count for the data volume) is left to spark-submit.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _local_heap() -> str:
    """Driver heap for local mode: 60 % of physical memory, at most 16 GB, so a
    small machine is not promised more than it has."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "revlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", _local_heap()))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, sub: str = "") -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    On a cluster this setting names the shared file system folder, and a
    cluster session without it is refused (a machine-local folder would not be
    seen by other executors). Only a local-mode session without it (tests)
    gets a fresh temporary folder, registered so later ``checkpoint()`` calls
    and model saves land there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on the shared file system")
        base = tempfile.mkdtemp(prefix="revlens-ckpt-")  # local mode only: one machine
        spark.conf.set("spark.checkpoint.dir", base)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/") + ("/" + sub.strip("/") if sub else "")

