"""Tables that are replaced in one step."""

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from skylag.sources import tables

DAYS = "day date, year int, run string"


def days(spark, first, last, run):
    n = (last - first).days + 1
    rows = [(first + timedelta(days=i), (first + timedelta(days=i)).year, run) for i in range(n)]
    return spark.createDataFrame(rows, DAYS)


def count_by_run(df):
    return {r["run"]: r["n"] for r in df.groupBy("run").agg(F.count("*").alias("n")).collect()}


def test_a_part_of_a_year_leaves_the_rest(spark, path):
    whole = days(spark, date(2024, 7, 1), date(2025, 12, 31), "old")
    tables.replace_table(whole, f"{path}/t", ("year",), within="day")
    january = days(spark, date(2025, 1, 1), date(2025, 1, 31), "new")
    out = tables.replace_table(january, f"{path}/t", ("year",), within="day")
    assert count_by_run(out) == {"old": 184 + 365 - 31, "new": 31}
    assert out.filter("run = 'new'").agg(F.max("day")).first()[0] == date(2025, 1, 31)
    # without a column that tells the part, whole partitions are replaced
    out = tables.replace_table(january.limit(3), f"{path}/t", ("year",))
    assert count_by_run(out) == {"old": 184, "new": 3}
    assert count_by_run(tables.replace_table(january, f"{path}/t")) == {"new": 31}


def test_readers_see_one_whole_version(spark, path):
    old = days(spark, date(2024, 1, 1), date(2025, 12, 31), "old")
    tables.replace_table(old, path, ("year",), within="day")
    before = tables.read_table(spark, path)
    seen = []

    class Watching(tables._Store):
        def put(self, *args):
            # all files of the new version are there, but nobody was told
            seen.append(count_by_run(tables.read_table(spark, path)))
            super().put(*args)

    kept, tables._Store = tables._Store, Watching
    try:
        tables.replace_table(days(spark, date(2024, 1, 1), date(2025, 12, 31), "new"), path, ("year",), within="day")
    finally:
        tables._Store = kept
    assert seen == [{"old": 731}]
    assert count_by_run(tables.read_table(spark, path)) == {"new": 731}
    # what was opened before the replacement still is the old version, whole
    assert count_by_run(before) == {"old": 731}
    for run in ("third", "fourth"):
        tables.replace_table(days(spark, date(2024, 1, 1), date(2025, 12, 31), run), path, ("year",), within="day")
    # folders that neither the table nor the version before refers to are gone
    assert len(os.listdir(f"{path}/_runs")) == 2


@pytest.mark.parametrize("partitions", [(), ("year",)])
def test_a_job_that_ends_early_leaves_the_old_version(spark, path, partitions):
    tables.replace_table(days(spark, date(2025, 1, 1), date(2025, 3, 1), "old"), path, partitions)
    broken = days(spark, date(2025, 1, 1), date(2025, 3, 1), "new").withColumn(
        "run", F.when(F.month("day") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("run"))
    )
    with pytest.raises(Exception, match="stop"):
        tables.replace_table(broken, path, partitions)
    assert count_by_run(tables.read_table(spark, path)) == {"old": 60}

    class Killed(tables._Store):
        def put(self, *args):
            raise KeyboardInterrupt

    kept, tables._Store = tables._Store, Killed
    try:
        with pytest.raises(KeyboardInterrupt):
            tables.replace_table(days(spark, date(2025, 1, 1), date(2025, 3, 1), "new"), path, partitions)
    finally:
        tables._Store = kept
    assert count_by_run(tables.read_table(spark, path)) == {"old": 60}
    # the next run clears what the dead ones left
    tables.replace_table(days(spark, date(2025, 1, 1), date(2025, 3, 1), "new"), path, partitions)
    assert len(os.listdir(f"{path}/_runs")) == 2


def test_null_keys_empty_frames_and_no_table(spark, path):
    rows = spark.createDataFrame([(None, None, "a"), (date(2025, 1, 1), 2025, "a")], DAYS)
    tables.replace_table(rows, path, ("year",), within="day")
    out = tables.replace_table(spark.createDataFrame([(None, None, "b")], DAYS), path, ("year",), within="day")
    assert sorted((r.run, r.year) for r in out.collect()) == [("a", 2025), ("b", None)]
    out = tables.replace_table(rows.limit(0), path, ("year",), within="day")
    assert out.count() == 2 and out.columns == ["day", "run", "year"]
    assert tables.replace_table(rows.limit(0), path).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, f"{path}/none")


def test_filters_prune_partitions(spark, path):
    out = tables.replace_table(days(spark, date(2024, 1, 1), date(2025, 12, 31), "x"), path, ("year",))
    plan = out.filter("year = 2025")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
