"""Session settings and the shared checkpoint folder.

On a cluster the session is created by the platform; ``configure`` only
adds the settings the jobs rely on (UTC, AQE with skew handling, scan
split and output partition sizes).  ``build_session`` is for tests, the
bench and local runs.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job expects.  Sizes follow the reference's workload
# settings: 256 MB scan splits and 128 MB output files.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "snappy",
    # Broadcast only when the planner's size estimate (file statistics or
    # AQE runtime size) is under this bound; beyond it Spark falls back to
    # a shuffle join by itself.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings (safe on an existing session)."""
    for key, value in CORE_CONF.items():
        if spark.conf.isModifiable(key):  # a static one stays the platform's
            spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerlake", extra_conf: dict | None = None) -> SparkSession:
    """Local/test session.  ``master`` defaults to ``local[$BENCH_CPUS or *]``."""
    if master is None:
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "8g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for key, value in {**CORE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the platform sets it to a shared file system; without it
    there is no folder that every executor reads, so that is an error.  In
    local mode, where driver and executors are one process, a fresh folder
    is set if there is none (tests, bench).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[[^-]*\])?$", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on whatever file system it names; a failure to
    look is an error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
