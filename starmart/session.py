"""Session defaults and the shared folder every executor can reach."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    # Event texts carry no zone; UTC makes dates independent of the machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The code generated for a long stage easily passes the size up to which
    # the JVM compiles a method; beyond it the stage would be interpreted.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def build_session(app_name: str = "starmart", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults. Memory, cores and partition counts stay with the caller."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where none is set, a local session gets a temporary one. On several machines such a folder would be another one for
    each executor, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")
