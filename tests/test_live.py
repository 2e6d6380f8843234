import json
from datetime import date, datetime

from pyspark.sql import functions as F

from skylag import fixed, schemas
from skylag.operators import feeds
from skylag.plans import live
from skylag.streaming import jobs, runs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_weather_from_files_to_lines_and_table(spark, tmp_path):
    names = ["extra", *reversed(schemas.METAR_RAW.fieldNames())]

    def line(station, time, temp):
        return ",".join({"station_id": station, "observation_time": time, "temp_c": temp}.get(n, "") for n in names)

    (tmp_path / "in").mkdir()
    for poll, lines in enumerate(
        [
            [line("EPWA", "2020-05-01T13:20:00Z", "12.5"), line("EPWA", "bad", "1")],
            [line("EPWA", "2020-05-01T13:20:00Z", "12.5"), line("EDDF", "2026-05-01T13:20:00Z", "7")],
        ]
    ):
        (tmp_path / "in" / f"p{poll}.csv").write_text("\n" + "\n".join([",".join(names), *lines]) + "\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    messages = runs.run_bounded(live.weather_out(spark, str(tmp_path / "in")))
    assert set(json.loads(messages.first().value)["full_record"]) == set(names)
    assert rows(messages.select("key", "topic")) == [
        ("EDDF|2026-05-01T13:20:00Z", "weather"), ("EPWA|2020-05-01T13:20:00Z", "weather"),
        ("EPWA|bad", "weather"),
    ]
    assert rows(live.weather_lines(messages)) == [
        ("[EDDF] 2026-05-01T13:20:00Z 7C ",), ("[EPWA] 2020-05-01T13:20:00Z 12.5C ",),
        ("[EPWA] bad 1C ",),
    ]


def test_delays_from_files_to_csv_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    records = [{"flight_iata": "LO1", "dep_iata": {"x": 1}, "_source": "mine"}, {"arrival_iata": "WAW", "gate": [1, "B"]}, {}]
    (tmp_path / "in" / "a.json").write_text(json.dumps({"response": {"flights": records}}, indent=1))
    (tmp_path / "in" / "b.json").write_text("{bad")
    messages = runs.run_bounded(live.delays_out(spark, str(tmp_path / "in")))
    assert [r.key for r in messages.orderBy("key").collect()] == ["LO1", "WAW", "unknown-flight"]
    bodies = [json.loads(r.value) for r in messages.orderBy("key").collect()]
    assert bodies[0]["_source"] == "airlabs" and bodies[0]["dep_iata"] == {"x": 1}
    assert bodies[2].keys() == {"_source", "_fetched_at", "_airlabs_delay_threshold", "_airlabs_type"}
    flat = live.delay_records(messages)
    assert all(kind == "string" for _, kind in flat.dtypes) and flat.count() == 3
    got = {r.arrival_iata: (r.dep_iata, r.rest) for r in flat.collect()}
    assert got["WAW"] == (None, '{"gate":[1,"B"]}')
    assert sorted(r.dep_iata for r in flat.filter("dep_iata IS NOT NULL").collect()) == ['{"x":1}']


def test_boards_from_files(spark, tmp_path):
    board = {"result": {"response": {"airport": {"pluginData": {"schedule": {"departures": {"data": [
        {"flight": {"identification": {"number": {"default": "LO1"}}}}]}}}}}}}
    for airport in ("EPWA", "EGLL"):
        (tmp_path / "in" / f"airport={airport}").mkdir(parents=True)
        (tmp_path / "in" / f"airport={airport}" / "b.json").write_text(json.dumps(board))
    messages = runs.run_bounded(live.boards_out(spark, str(tmp_path / "in")))
    assert rows(messages.select("key", "topic")) == [("departure", "EGLL"), ("departure", "EPWA")]
    assert rows(jobs.board_lines(messages.filter("topic = 'EGLL'"))) == [
        ("[EGLL] ODLOT  | Lot: LO1 do None | Status: None",)
    ]


def test_event_log_from_files(spark, tmp_path):
    cells = [f"c{i}" for i in range(61)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\t".join(cells) + "\n" + "\t".join(cells[:60]) + "\n\n")
    row = runs.run_bounded(live.event_log_out(spark, str(tmp_path / "in"))).collect()
    assert len(row) == 1 and row[0].key == "c0" and row[0].topic == "gdelt_raw"
    body = json.loads(row[0].value)
    assert body["source"] == "gdelt" and body["format"] == "gdelt_events"
    assert list(body["record"]) == list(fixed.EVENT_LOG_FIELDS) and body["record"]["SOURCEURL"] == "c60"


def test_salted_join_and_dedup_change_nothing(spark, path):
    seen = spark.range(2000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("station"),
        F.lit(datetime(2026, 5, 1)).cast("date").alias("date"), F.lit(1).alias("hour"),
        F.timestamp_seconds(F.lit(1777593600) + F.col("id") % 40).alias("ts"), F.col("id"),
    )
    hours = spark.createDataFrame(
        [("hot", datetime(2026, 5, 1).date(), 1, 5.0), ("s1", datetime(2026, 5, 1).date(), 1, 6.0)],
        "station string, date date, hour int, hour_temperature double",
    )
    assert rows(jobs.join_hourly_weather(seen, hours, salts=5)) == rows(jobs.join_hourly_weather(seen, hours))
    seen.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(seen.schema).parquet(f"{path}/in")
    kept = runs.run_bounded(jobs.drop_repeats(stream, "station", "ts", salts=3).select("station", "ts"))
    assert rows(kept) == rows(seen.select("station", "ts").distinct())


def test_large_limit_is_exact(spark):
    from skylag.operators import ranking

    data = spark.range(1000, numPartitions=5)
    kept = ranking.limit_records(data, 300, F.desc("id"))
    assert sorted(r.id for r in kept.collect()) == list(range(700, 1000))


def test_files_with_another_header_are_refused(spark, tmp_path):
    import pytest

    from skylag.sources import files
    from tests.test_sources import SMALL

    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("a,z\n1,2\n")
    (tmp_path / "t" / "b.csv").write_text("z,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_csv(spark, str(tmp_path / "t"), SMALL).collect()


def test_payload_text_column_name(spark):
    df = spark.createDataFrame([('{"data": [{"flight_number": "7"}]}',)], "value string")
    assert feeds.delay_messages(df, "value", topic="d").first().key == "7"


def test_enrich_sees_a_replaced_weather_table(spark, tmp_path):
    from skylag.plans import batch

    def message(key, time):
        event = {"station_id": key, "observation_time": time, "temp_c": "1"}
        return (json.dumps(event),)

    def table(value, year=2026):
        hours = spark.createDataFrame(
            [("EPWA", date(year, 5, 1), 13, value, 0.0, 0.0)],
            "station string, date date, hour int, hour_temperature double, hour_precipitation double, hour_wind_gusts double",
        )
        batch._save(hours, str(tmp_path / "tables"), batch.STATION_HOUR, by_year=True)

    def run(*messages):
        spark.createDataFrame(list(messages), "value string").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("value string").parquet(str(tmp_path / "in"))
        query = live.enrich(stream, str(tmp_path / "out"), str(tmp_path / "tables"), str(tmp_path / "state"), **runs.BOUNDED)
        query.awaitTermination()

    table(5.0)
    run(message("EPWA", "2026-05-01T13:20:00Z"), message("EPWA", "bad"))
    table(9.0)
    table(3.0, 2025)
    run(message("EPWA", "2026-05-01T13:40:00Z"))
    got = spark.read.parquet(str(tmp_path / "out")).select("batch", "hour_temperature")
    assert rows(got) == [(0, 5.0), (0, None), (1, 9.0)]


def test_flights_of_a_topic_with_recent_weather(spark, tmp_path):
    flights = [
        {"flight_iata": "LO1", "dep_icao": "EPWA", "dep_time_utc": "2026-05-01 13:30", "delay": 40},
        {"flight_iata": "LO2", "dep_icao": "EPWA", "dep_time_utc": "2026-05-01 16:00", "delay": "25"},
        {"flight_iata": "LO3", "dep_icao": None, "dep_time_utc": "2026-05-01 13:30"}, {"dep_icao": "EPWA", "dep_time_utc": "soon"},
    ]
    seen = [
        {"station_id": "EPWA", "observation_time": f"2026-05-01T{t}:00Z", "temp_c": c} for t, c in (("13:00", "7"), ("12:00", "3"), ("20:00", "1"))
    ]
    for name, rows_ in (("f", flights), ("w", seen)):
        spark.createDataFrame([(str(i), json.dumps(r)) for i, r in enumerate(rows_)], "key string, value string").write.parquet(f"{tmp_path}/{name}")
    later = [("9", json.dumps({**flights[0], "flight_iata": "LO9", "dep_time_utc": "2026-05-02 13:30"}))]
    spark.createDataFrame(later, "key string, value string").write.mode("append").parquet(f"{tmp_path}/f")
    streams = [spark.readStream.schema("key string, value string").parquet(f"{tmp_path}/{n}") for n in "fw"]
    out = runs.run_bounded(live.flights_with_weather(*streams))
    # the last one waits: the watermark of the observations has not passed it
    assert rows(out.select("flight", "delay", "temp_c")) == [("0", 40.0, 7.0), ("1", 25.0, None)]


def test_published_observations_are_known_while_polls_repeat_them(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for poll in range(2):
        (tmp_path / "in" / f"p{poll}.csv").write_text(
            "station_id,observation_time,temp_c\nEPWA,2020-05-01T13:20:00Z,1\nEPWA,bad,2\nEDDF,2020-05-01T13:20:00Z,3\n"
        )
    with runs.state_on_disk(spark):
        messages = runs.run_bounded(live.weather_out(spark, str(tmp_path / "in"), forget="2 hours"))
    assert rows(messages.select("key")) == [("EDDF|2020-05-01T13:20:00Z",), ("EPWA|2020-05-01T13:20:00Z",), ("EPWA|bad",)]
