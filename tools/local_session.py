"""A local session for tests, comparison and measurement."""

from __future__ import annotations

from pyspark.sql import SparkSession

from skylag.session import RUNTIME_CONF


def local_session(cpus: int | str = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("skylag-local")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
