"""First rows of many keys: one value of state for a group of keys, and copies reduced where they arrive."""

from datetime import date, datetime, timedelta

import pytest

from skylag.streaming import runs
from skylag.streaming.first_rows import _reducer, first_rows

DAY = datetime(2024, 1, 1)
KINDS = "id long, a string, b timestamp, c date, d binary, x double, arrived timestamp"


def test_state_of_many_keys_is_few_values(spark, path):
    """It was a value and a timer for each key."""
    spark.range(9000).selectExpr("id", "id % 6000 AS k", "timestamp_seconds(1700000000) AS arrived").coalesce(1).write.parquet(f"{path}/in")
    df = first_rows(spark.readStream.schema("id long, k long, arrived timestamp").parquet(f"{path}/in"), "k", arrived="arrived")
    with runs.state_on_disk(spark):
        query = runs.start(df, f"{path}/data", f"{path}/checkpoint", **runs.BOUNDED)
        query.awaitTermination()
    out = spark.read.schema(df.schema).parquet(f"{path}/data")
    assert out.count() == out.filter("is_first").count() == 6000 and out.agg({"repeats": "sum"}).first()[0] == 3000
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 4096


@pytest.mark.parametrize("keys", [("a", "b", "c", "d"), ("x",)])
def test_keys_of_any_kind_with_nulls_across_batches(spark, path, keys):
    texts = [None, "", "-", ",", "a,b", "é"]
    rows = [
        (n, texts[n % 6], None if n % 4 == 1 else DAY + timedelta(microseconds=n % 2), None if n % 3 else date(2024, 1, 1),
         None if n % 5 else b"\xff", [None, 0.0, -0.0, float("nan"), 1.5][n % 5], DAY + timedelta(minutes=n))
        for n in range(240)
    ]
    for n in range(2):
        spark.createDataFrame(rows[n * 120 : n * 120 + 120], KINDS).coalesce(2).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(KINDS).option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    with runs.state_on_disk(spark):
        out = runs.run_bounded(first_rows(stream, *keys, arrived="arrived", forget="400 hours", late_by="9 hours")).collect()
    expected = first_rows(spark.createDataFrame(rows, KINDS), *keys, arrived="arrived").count()
    kept = [r for r in out if r.is_first]
    assert len(kept) == expected and len(kept) + sum(r.repeats for r in out) == len(rows)


def test_a_reduced_part_is_bounded_and_keeps_the_first_and_all_counts():
    import pyarrow as pa

    def batches(repeat):
        for n in range(40):
            at = list(range(n * 500, n * 500 + 500))
            yield pa.RecordBatch.from_pydict({
                "id": at, "_key": [str(i % repeat) for i in at], "_arrived_ms": [-i for i in at], "_order": at,
                "_latest_ms": [-i for i in at], "_number": [1] * 500,
            })

    (few,) = _reducer(most=1000)(batches(10))
    assert sorted(few.column("id").to_pylist()) == list(range(19_990, 20_000))
    assert few.column("_number").to_pylist() == [2000] * 10
    assert sorted(few.column("_latest_ms").to_pylist()) == list(range(-9, 1))
    many = list(_reducer(most=1000)(batches(20_000)))
    assert len(many) > 10 and sum(len(b) for b in many) == 20_000
