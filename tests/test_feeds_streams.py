import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import schemas
from skylag.operators import feeds
from skylag.streaming import jobs, runs

AB = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def test_decode_drops_what_is_not_a_json_object(spark):
    bodies = [
        b'{"a": 1, "b": {"x": [1]}}', b"{", b"", b"[1]", b'"t"', None, b'{"a": "\xff"}', b"{}",
        b' {"a": "\xc3\xa9", "c": 2} \n', b'{"a": 1} junk', b'{"a": 1}{"b": 2}', b'{"a": 1},{"b": 2}',
        b'{"a": 1,}', b"{'a': 1}", b'{"a": 1, "b":', b'{"n": "word", "a": 2}', b"null", b'{"a": 1}]',
    ]
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None)
                                for i, b in enumerate(bodies)], "key int, value binary")
    typed = T.StructType([*AB.fields, T.StructField("n", T.IntegerType())])
    rows = {r.key: (r.a, r.b, r.n) for r in feeds.decode_json(df, typed, keep=("key",)).collect()}
    assert rows == {
        0: ("1", '{"x":[1]}', None), 7: (None, None, None), 8: ("é", None, None), 15: ("2", None, None),
    }


def test_decoding_parses_each_message_once(spark, path):
    spark.createDataFrame([("k", bytearray(b"{}"))], "key string, value binary").write.parquet(f"{path}/m")
    df = feeds.decode_json(spark.read.parquet(f"{path}/m"), AB)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_feed_lists(spark):
    record = {"flight_iata": "LO1", "delay": 12.5, "new": {"deep": [1]}}
    payloads = [
        {"response": [record]}, {"data": [record, record]}, {"flights": [record]}, {"result": [record]},
        {"response": {"data": [record]}}, {"response": {"result": [record]}},
        {"response": [], "data": [record]}, {"response": {"data": {"a": 1}}}, {"response": "x"}, {}, [],
    ]
    texts = [json.dumps(p) for p in payloads] + ["{bad"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    rows = feeds.record_columns(feeds.feed_records(df)).collect()
    counts = {i: 0 for i in range(len(texts))}
    for r in rows:
        counts[r.id] += 1
        assert (r.flight_iata, r.delay, r.arr) == ("LO1", "12.5", None)
    assert list(counts.values()) == [1, 2, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0]


def test_provenance(spark):
    row = spark.range(1).withColumns(feeds.provenance(30, "arrivals")).first()
    assert row._source == "airlabs" and row._airlabs_delay_threshold == 30
    assert row._airlabs_type == "arrivals" and abs(row._fetched_at - datetime.now().timestamp()) < 3600
    fixed_time = spark.range(1).withColumns(feeds.provenance(fetched_at=F.lit(7))).first()
    assert fixed_time._fetched_at == 7


def test_messages_keep_nulls_and_route_by_row(spark):
    df = spark.createDataFrame([("EGLL", "arrival", None), ("EPWA", "departure", 2)],
                               "airport string, direction string, n int")
    rows = feeds.json_messages(df, F.col("direction"), F.col("airport"), ["n"]).collect()
    assert [tuple(r) for r in rows] == [
        ("arrival", '{"n":null}', "EGLL"), ("departure", '{"n":2}', "EPWA"),
    ]


def test_nested_to_json(spark):
    df = spark.sql("SELECT 1 AS i, named_struct('x', 1, 'y', null) AS s, array(1, 2) AS l, map('k', 'v') AS m")
    assert tuple(feeds.nested_to_json(df).first()) == (1, '{"x":1,"y":null}', "[1,2]", '{"k":"v"}')


def test_board_levels_may_be_missing(spark):
    full = {
        "flight": {
            "identification": {"number": {"default": "LO1"}, "callsign": "LOT1"},
            "airline": {"name": "", "short": "LOT"},
            "airport": {"origin": {"code": {"iata": "WAW"}, "position": {"region": {"city": "Warsaw"}}},
                        "destination": None},
            "status": {"text": "Landed"},
            "time": {"scheduled": {"departure": 3660, "arrival": 0}},
        }
    }

    def board(**sides):
        schedule = {k: {"data": v} for k, v in sides.items()}
        return json.dumps({"result": {"response": {"airport": {"pluginData": {"schedule": schedule}}}}})

    texts = [board(arrivals=[full, {}], departures=[{"flight": {}}]), board(departures=[full]), board(),
             "{}", '{"result": null}', "bad"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    rows = [tuple(r) for r in feeds.board_rows(df).collect()]
    known = ("LO1", "LOT1", "LOT", "WAW", "Warsaw", None, None, "Landed", "01:01", "Brak")
    empty = (None, None, "", None, None, None, None, None, "Brak", "Brak")
    assert sorted(rows, key=str) == sorted(
        [(0, "arrival", *known), (0, "arrival", *empty), (0, "departure", *empty), (1, "departure", *known)],
        key=str,
    )


def test_board_lines(spark):
    body = bytearray(b'{"flight_number": "LO1", "origin_iata": "WAW", "status": null}')
    df = spark.createDataFrame(
        [("EPWA", "arrival", body), ("EPWA", "departure", body), ("EPWA", None, body)],
        "topic string, key string, value binary",
    )
    lines = [r.line for r in jobs.board_lines(df).collect()]
    assert lines == [
        "[EPWA] PRZYLOT | Lot: LO1 z WAW | Status: None",
        "[EPWA] ODLOT  | Lot: LO1 do None | Status: None",
        f"[EPWA] INNE   | Typ: UNKNOWN | Dane: {body.decode()}",
    ]


def test_csv_documents(spark):
    bodies = ["b,a\n1,2\n\n3\n", 'a\r\n"x,""y"""\r\nz,extra', "a,a\n1,2", "a,b", "", " \n ", None]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, value string")
    rows = [(r.id, r.record) for r in feeds.csv_documents(df).collect()]
    assert rows == [
        (0, {"b": "1", "a": "2"}), (0, {"b": "3", "a": None}), (1, {"a": 'x,"y"'}), (1, {"a": "z"}),
        (2, {"a": "2"}),
    ]


def test_metar_event(spark):
    raw = spark.createDataFrame(
        [{**{f: None for f in schemas.METAR_RAW.fieldNames()}, "station_id": "EPWA",
          "observation_time": "2026-05-01T13:20:00Z", "temp_c": "12.0"}], schemas.METAR_RAW)
    event = feeds.metar_events(raw).first()
    assert event.asDict().keys() == set(schemas.METAR_EVENT.fieldNames())
    assert event.feature_join_key == "EPWA|2026-05-01|2026-05-01T13:00:00+00:00"
    assert event.full_record["temp_c"] == "12.0" and len(event.full_record) == 16


# --- streams ------------------------------------------------------------------------------------------

T0 = datetime(2026, 5, 1)
OBSERVED = "station string, ts timestamp, date date, hour int, temp_c double, wind_speed_kt double"


def observations(spark, path, minutes_by_file):
    for minutes in minutes_by_file:
        times = [T0 + timedelta(minutes=m) for m in minutes]
        spark.createDataFrame(
            [(f"S{i % 2}", t, t.date(), t.hour, float(i), float(i)) for i, t in enumerate(times)], OBSERVED
        ).coalesce(1).write.mode("append").parquet(f"{path}/in")
    table = spark.read.parquet(f"{path}/in")
    return table, spark.readStream.schema(OBSERVED).parquet(f"{path}/in")


def test_dedup_stream_equals_batch(spark, path):
    table, stream = observations(spark, path, [[0, 1, 1, 5], [0, 1, 60, 61, 61]])
    got = runs.run_bounded(jobs.drop_repeats(stream, "station", "ts").select("station", "ts"))
    expected = jobs.drop_repeats(table, "station", "ts").select("station", "ts")
    assert sorted(got.collect()) == sorted(expected.collect())


def test_hourly_stream_gives_closed_hours_of_the_batch_result(spark, path):
    table, stream = observations(spark, path, [range(0, 600, 7)])
    got = {tuple(r) for r in runs.run_bounded(jobs.hourly_statistics(stream)).collect()}
    latest = table.agg(F.max("ts")).first()[0]
    every = {tuple(r) for r in jobs.hourly_statistics(table).collect()}
    closed = {r for r in every if r[1] + timedelta(hours=1) <= latest - timedelta(hours=2)}
    assert got == closed and 0 < len(closed) < len(every)


def test_static_join_keeps_the_stream(spark, path):
    _, stream = observations(spark, path, [[0, 30, 90]])
    hours = spark.createDataFrame([("S0", T0.date(), 0, 7.5)], "station string, date date, hour int, hour_temperature double")
    rows = runs.run_bounded(jobs.join_hourly_weather(stream, hours)).select("station", "hour_temperature").collect()
    assert sorted(map(tuple, rows), key=str) == [("S0", 7.5), ("S0", None), ("S1", None)]


def test_checkpoint_continues_where_it_ended(spark, path):
    observations(spark, path, [[0, 1]])
    stream = spark.readStream.schema(OBSERVED).parquet(f"{path}/in")
    for _ in range(2):
        runs.start(stream, f"{path}/out", f"{path}/c", **runs.BOUNDED).awaitTermination()
    observations(spark, path, [[2]])
    runs.start(stream, f"{path}/out", f"{path}/c", **runs.BOUNDED).awaitTermination()
    assert spark.read.schema(OBSERVED).parquet(f"{path}/out").count() == 3


def test_default_trigger_and_console(spark, path):
    _, stream = observations(spark, path, [[0]])
    query = runs.console(stream.select("station"), **runs.BOUNDED)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    assert runs.POLL == {"processingTime": "60 seconds"}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_land_formats(spark, path, fmt):
    _, stream = observations(spark, path, [[0, 1, 2]])
    out = runs.land(stream.select("station", "temp_c"), fmt=fmt)
    read = spark.read.parquet(out) if fmt == "parquet" else spark.read.csv(out, header=True)
    assert read.count() == 3
