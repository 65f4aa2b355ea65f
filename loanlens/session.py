"""Spark session defaults for the engine.

The engine never creates its own cluster configuration on a real cluster:
``get_session`` only fills in settings that are still unset, so whatever the
cluster operator put into ``spark-defaults.conf`` (shuffle partitions,
checkpoint directory, memory) wins.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every query relies on for correct results (zone, ANSI) or for a
# scale-safe physical plan (AQE, skew join, partition coalescing).
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "loanlens") -> SparkSession:
    """Return the active session, creating a local one for tests and benches."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the executor too
            builder = builder.config("spark.driver.memory", "8g")
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _REQUIRED.items():
        spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (``spark.checkpoint.dir``).

    On a cluster this must already be set to a shared file system; a local
    temporary folder is only chosen when nothing is configured (tests).
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="loanlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def expensive_to_recompute(df) -> bool:
    """True when the optimized plan has a join or an aggregate (re-reading a plain scan is cheap)."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return "Join " in plan or "Aggregate " in plan


class persisted:
    """Context manager for multi-pass fits (like MLlib's handlePersistence).

    ``mode="auto"`` persists (MEMORY_AND_DISK) only inputs that are expensive
    to recompute and not already cached; the cache is released on exit.
    """

    def __init__(self, df, mode: str = "auto"):
        self.df, self.mode, self.did = df, mode, False

    def __enter__(self):
        from pyspark import StorageLevel
        cached = self.df.storageLevel != StorageLevel(False, False, False, False, 1)
        want = self.mode is True or self.mode == "always" or (
            self.mode == "auto" and expensive_to_recompute(self.df))
        if want and not cached:
            self.df.persist(StorageLevel.MEMORY_AND_DISK)
            self.did = True
        return self.df

    def __exit__(self, *exc):
        if self.did:
            self.df.unpersist()
        return False
