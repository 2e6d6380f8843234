"""Streams with state of their own: first rows of keys, and flights joined to recent weather."""

import os
from datetime import datetime, timedelta

import pytest

from skylag.streaming import jobs, runs
from skylag.streaming.first_rows import first_rows

DAY = datetime(2024, 1, 1)


def land(spark, path, rows, schema):
    """One more file, newer than those before, as streams take files by their time."""
    def names():
        return {f for f in os.listdir(path) if f.endswith(".parquet")} if os.path.exists(path) else set()

    before = names()
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    (new,) = names() - before
    os.utime(os.path.join(path, new), (1.7e9 + len(before) * 10,) * 2)


def run(spark, df, path):
    """Run to the end of what has landed; the progress of its batches, and all rows written so far."""
    with runs.state_on_disk(spark):
        query = runs.start(df, f"{path}/data", f"{path}/checkpoint", **runs.BOUNDED)
        query.awaitTermination()
    return query.recentProgress, spark.read.schema(df.schema).parquet(f"{path}/data")


KEYED = "id long, k string, own timestamp, arrived timestamp"


def keyed(spark, path):
    return spark.readStream.schema(KEYED).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("forget", ["", "2 hours"])
def test_first_rows_of_keys_across_batches_and_restarts(spark, path, forget):
    def rows(*given):
        # the rows' own times go back by years: no watermark on them would let these rows in
        return [(i, k, DAY - timedelta(days=400 * i), DAY + timedelta(minutes=m)) for i, k, m in given]

    source = f"{path}/in"
    land(spark, source, rows((1, "a", 0), (2, "a", 1), (3, "b", 10), (4, None, 10)), KEYED)
    land(spark, source, rows((5, "a", 30), (6, None, 31)), KEYED)
    df = first_rows(keyed(spark, source), "k", arrived="arrived", forget=forget)
    run(spark, df, path)
    # another run of the same checkpoint: what was seen before is still known
    land(spark, source, rows((7, "c", 300), (8, "b", 301)), KEYED)
    land(spark, source, rows((9, "a", 302), (10, "c", 302), (11, "c", 303)), KEYED)
    _, out = run(spark, df, path)
    kept = {r.id: r.repeats for r in out.filter("is_first").collect()}
    dropped = out.agg({"repeats": "sum"}).first()[0]
    if forget:
        # a and b were not seen for over two hours
        assert kept == {1: 1, 3: 0, 4: 0, 7: 0, 8: 0, 9: 0}
    else:
        assert kept == {1: 1, 3: 0, 4: 0, 7: 0}
    assert sum(kept.values()) <= dropped and len(kept) + dropped == 11
    assert all(r.k is None and r.own is None for r in out.filter("not is_first").collect())


def test_forgotten_keys_leave_the_state(spark, path):
    source = f"{path}/in"
    for n in range(4):
        land(spark, source, [(n * 100 + i, f"k{n}-{i}", DAY, DAY + timedelta(hours=5 * n)) for i in range(50)], KEYED)
    df = first_rows(keyed(spark, source), "k", arrived="arrived", forget="1 hour")
    progress, out = run(spark, df, path)
    assert out.filter("is_first").count() == 200
    state = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(state) < 200 * 3 and state[-1] <= max(state)


def test_a_table_has_the_same_first_rows(spark):
    rows = [(1, "a", DAY, DAY), (2, "a", DAY, DAY - timedelta(hours=1)), (3, None, DAY, DAY), (4, None, DAY, DAY + timedelta(hours=1))]
    out = first_rows(spark.createDataFrame(rows, KEYED), "k", arrived="arrived")
    assert sorted((r.id, r.k, r.is_first, r.repeats) for r in out.collect()) == [(2, "a", True, 1), (3, None, True, 1)]


FLIGHT, SEEN = "flight long, station string, ts timestamp", "station string, ts timestamp, temp_c double"


def test_flights_meet_recent_weather_and_state_is_dropped(spark, path):
    def at(minutes):
        return DAY + timedelta(minutes=minutes)

    flights, seen = f"{path}/flights", f"{path}/seen"
    all_flights, all_seen = [], []
    for hour in range(0, 30, 3):
        part = [(hour * 10 + i, f"S{i % 3}", at(hour * 60 + i)) for i in range(6)]
        # stations S0 and S1 report, S2 does not
        obs = [(f"S{s}", at(hour * 60 - 20 + s), float(hour)) for s in range(2)]
        land(spark, flights, part, FLIGHT)
        land(spark, seen, obs, SEEN)
        all_flights += part
        all_seen += obs
    # far later than the watermark on both sides, and one without a station
    land(spark, flights, [(1000, "S0", at(0)), (1001, None, at(1700))], FLIGHT)
    land(spark, seen, [("S0", at(-5), -1.0)], SEEN)
    streams = [
        spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(p) for p, s in ((flights, FLIGHT), (seen, SEEN))
    ]
    progress, out = run(spark, jobs.join_recent_weather(*streams, reach="30 minutes", late_by="1 hour"), path)
    got = sorted((r.flight, r.observed_at, r.temp_c) for r in out.filter("temp_c IS NOT NULL").collect())
    expected = sorted(
        (f, t2, c) for f, s, t in all_flights for s2, t2, c in all_seen
        if s == s2 and t - timedelta(minutes=30) <= t2 <= t
    )
    assert got == expected and expected
    # without weather: once each, as soon as the watermark (26 hours) has passed them
    alone = sorted(r.flight for r in out.filter("temp_c IS NULL").collect())
    assert alone == sorted(f for f, s, t in all_flights if s == "S2" and t < at(26 * 60 - 20))
    state = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(state) < 30 and state[-1] < len(all_flights) + len(all_seen)
    # tables give all of them at once
    tables = [spark.read.parquet(p) for p in (flights, seen)]
    whole = jobs.join_recent_weather(*tables, reach="30 minutes")
    assert whole.filter("temp_c IS NULL").count() == sum(s == "S2" for _, s, _ in all_flights) + 1
