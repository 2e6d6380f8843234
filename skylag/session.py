"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job needs: dates are UTC, plans adapt to real sizes, and one
# hot join key is split over several tasks instead of filling one.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Added by build_session for a cluster. Larger splits mean fewer partial aggregates to
# shuffle; the initial partition number is high because AQE merges what is too small.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # keys of a stream are kept on disk, not in the executors' heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else made."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "skylag", **conf: str) -> SparkSession:
    """A session for a cluster job. The master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**RUNTIME_CONF, **CLUSTER_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the folder that spark.checkpoint.dir names.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "skylag")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, name: str):
    """Write `df` to the shared folder and read it back, which cuts its lineage.

    What was shuffled for it goes at once, not when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, work_path(df.sparkSession, name)
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)
