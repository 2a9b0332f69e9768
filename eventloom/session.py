"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # wide typed tables: more compiled stages than the default cache holds
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def local_session(cores: str = "*", name: str = "eventloom", partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's `spark.checkpoint.dir`.

    Only a local session that names none gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = spark.sparkContext.getCheckpointDir()
    if own is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventloom-"))
        own = spark.sparkContext.getCheckpointDir()
    return own
