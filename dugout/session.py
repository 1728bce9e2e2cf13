"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
# Wide generated stages (the 59 spin columns) exceed the size up to which the JVM compiles a
# method; without this flag they run interpreted, about five times slower.
JIT_FLAG = "-XX:-DontCompileHugeMethods"


def local_session(cpus: int | str = "*", name: str = "dugout", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.driver.extraJavaOptions", JIT_FLAG)
        .config("spark.executor.extraJavaOptions", JIT_FLAG)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Also makes sure reliable checkpoints have a target. A machine-local folder is made
    only where the setting is absent and the session itself is local.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="dugout-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so a rerun cannot read old files."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
