"""Names, queries and SQL twins of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from skylag.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# whole texts travel to Python in batches of so many rows and bytes at most
BATCH_ROWS, BATCH_BYTES = 4096, 32 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this library's settings and bounded batches for Python."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # intermediate tables of texts take two thirds of the space they would otherwise
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    return spark


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query of (spark, sf_dir) and, where SQL can express it, its twin."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(prepared(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register
