"""Starting streams: continuous with a poll interval, or once over what has arrived."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from skylag.session import CLUSTER_CONF, work_path
from skylag.sources.files import CSV_OPTIONS, one_line_cells

POLL = {"processingTime": "60 seconds"}
BOUNDED = {"availableNow": True}
# parts of a bounded run's state: so many for each core, and so many in all, unless the session has fewer
PARTS_OF_CORE, LEAST_PARTS = 2, 16


def file_stream(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """Landed Parquet files as a stream.

    Without `maxFilesPerTrigger` a bounded run reads all files as one batch, so nothing is
    late and nothing is dropped, in whatever order the files are listed.
    """
    # the pattern also matches a single file, which a plain path does not
    pattern = path if "*" in path else f"{path.rstrip('/')}*"
    return spark.readStream.schema(schema).options(**options).parquet(pattern)


def start(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", **trigger):
    """Append a stream to files of a format. The trigger is a 60 second poll by default."""
    return (
        (one_line_cells(df) if fmt == "csv" else df).writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**(CSV_OPTIONS if fmt == "csv" else {}))
        .outputMode("append")
        .trigger(**(trigger or POLL))
        .start()
    )


def land(df: DataFrame, name: str = "stream", fmt: str = "parquet") -> str:
    """Run a stream over everything that has arrived, into a new path, and return the path."""
    path = work_path(df.sparkSession, name)
    with _parts_by_cores(df.sparkSession):
        query = start(df, f"{path}/data", f"{path}/checkpoint", fmt, **BOUNDED)
    query.awaitTermination()
    return f"{path}/data"


def run_bounded(df: DataFrame, name: str = "stream") -> DataFrame:
    """Run a stream over everything that has arrived, and return what it wrote."""
    return df.sparkSession.read.schema(df.schema).parquet(land(df, name))


def poll_once(df: DataFrame, name: str = "poll", **trigger) -> DataFrame:
    """Run a polled stream until it has caught up, stop it, and return what it wrote."""
    path = work_path(df.sparkSession, name)
    query = start(df, f"{path}/data", f"{path}/checkpoint", **(trigger or POLL))
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")


def console(df: DataFrame, rows: int = 20, **trigger):
    """Print a stream's rows, for a look at it."""
    return (
        df.writeStream.format("console")
        .options(numRows=rows, truncate=False)
        .trigger(**(trigger or POLL))
        .start()
    )


@contextmanager
def _parts_by_cores(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside have no more parts than a few for each core.

    Every part of a state is opened and committed as files in every batch, whatever it holds, and a
    join of two streams has four of them; nothing merges small ones, as AQE does for tables.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    most = max(LEAST_PARTS, PARTS_OF_CORE * spark.sparkContext.defaultParallelism)
    spark.conf.set(name, str(min(int(before), most)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their keys on disk, as those of a cluster session do."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, CLUSTER_CONF[name])
    try:
        yield
    finally:
        spark.conf.set(name, before)


def observed(query, name: str) -> dict[str, int]:
    """The metrics of that name, summed over the batches a query still reports."""
    out: dict[str, int] = {}
    for progress in query.recentProgress:
        row = (progress.get("observedMetrics") or {}).get(name)
        for key, value in (row.asDict() if row is not None else {}).items():
            out[key] = out.get(key, 0) + value
    return out
