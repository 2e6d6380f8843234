"""Tables that are replaced in one step: each run writes a folder of its own, and a small file says which count."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# names that begin so are passed over by readers that know nothing of runs; they get an error, not a mixture
RUNS, CURRENT = "_runs", "_current.json"


class _Store:
    """The few file operations that a replacement needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at(path).getFileSystem(self._conf)

    def text(self, path: str) -> str | None:
        if not self._fs.exists(self._at(path)):
            return None
        source = self._fs.open(self._at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def put(self, path: str, text: str) -> None:
        """Whoever reads the file gets its old or its new content, never a part."""
        fresh = f"{path}.{uuid.uuid4().hex}"
        out = self._fs.create(self._at(fresh), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        whole = self._fs.makeQualified(self._at(path))
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), self._conf)
        overwrite = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self._jvm.java.lang.reflect.Array.newInstance(overwrite.getClass(), 1)
        options[0] = overwrite
        context.rename(self._fs.makeQualified(self._at(fresh)), whole, options)

    def folders(self, path: str) -> list[str]:
        if not self._fs.exists(self._at(path)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(path)) if s.isDirectory())

    def delete(self, path: str) -> None:
        self._fs.delete(self._at(path), True)


def _current(store: _Store, path: str) -> dict | None:
    text = store.text(f"{path}/{CURRENT}")
    return None if text is None else json.loads(text)


def _parts(store: _Store, path: str, depth: int) -> list[str]:
    """Partition folders of a run, as `a=1/b=2`; the run itself without partition columns."""
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{name}".lstrip("/") for p in found for name in store.folders(f"{path}/{p}") if "=" in name]
    return found


def _open(spark: SparkSession, path: str, state: dict, only=None) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    by_run: dict[str, list[str]] = {}
    for part, run in sorted(state["parts"].items()):
        if only is None or part in only:
            by_run.setdefault(run, []).append(part)
    rows = None
    for run, parts in sorted(by_run.items()):
        base = f"{path}/{RUNS}/{run}"
        read = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{p}".rstrip("/") for p in parts])
        rows = read if rows is None else rows.unionByName(read)
    return spark.createDataFrame([], schema) if rows is None else rows.select(*schema.fieldNames())


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as its last whole replacement left it.

    What has been opened stays readable through one further replacement; open it anew to see that.
    Filters on partition columns prune the folders.
    """
    path = path.rstrip("/")
    state = _current(_Store(spark, path), path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    return _open(spark, path, state)


def replace_table(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), within: str | None = None
) -> DataFrame:
    """Replace a table, or with `partition_by` those of its partitions that `df` has, and return it.

    The rows go to a folder of this run. Only when all are there, one small file is renamed over
    the old one, which makes the whole replacement visible at once: a reader sees the table before
    or after it, and a job that ends early leaves the table as it was. With `within`, an ordered column
    such as a date, rows of these partitions that lie before the first or after the last value in `df`
    stay: a run over January does not take the rest of the year away.

    Partition values are gathered before the write, so that each gets few, large files; a partition too
    large for one task is split by AQE. Folders of the run before stay for readers that have opened
    them; older ones that nothing refers to are removed. One replacement of a table runs at a time.
    """
    path, run = path.rstrip("/"), uuid.uuid4().hex
    spark = df.sparkSession
    store = _Store(spark, path)
    old = _current(store, path)
    base = f"{path}/{RUNS}/{run}"

    def save(rows: DataFrame, mode: str) -> None:
        if partition_by:
            rows = rows.hint("rebalance", *map(F.col, partition_by))
            rows.write.mode(mode).partitionBy(*partition_by).parquet(base)
        else:
            rows.write.mode(mode).parquet(base)

    save(df, "errorifexists")
    schema = T.StructType([*[f for f in df.schema.fields if f.name not in partition_by], *[df.schema[c] for c in partition_by]])
    parts = _parts(store, base, len(partition_by))
    kept = dict(old["parts"]) if old and partition_by else {}
    if within and old:
        fresh = spark.read.schema(schema).parquet(base)
        bounds = fresh.agg(F.min(within).alias("low"), F.max(within).alias("high")).first()
        before = _open(spark, path, old, {p for p in parts if p in old["parts"]})
        if bounds["low"] is not None:
            outside = (F.col(within) < F.lit(bounds["low"])) | (F.col(within) > F.lit(bounds["high"]))
            save(before.filter(outside).select(*df.columns), "append")
    kept |= dict.fromkeys(parts, run)
    state = {"schema": schema.jsonValue(), "parts": kept, "before": sorted(set((old or {"parts": {}})["parts"].values()))}
    store.put(f"{path}/{CURRENT}", json.dumps(state))
    for name in store.folders(f"{path}/{RUNS}"):
        if name not in {*kept.values(), *state["before"], run}:
            store.delete(f"{path}/{RUNS}/{name}")
    return _open(spark, path, state)
