"""Checked queries: Structured Streaming over landed files, each run to the end of its input."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import fixed, schemas
from skylag.functions import text
from skylag.operators import feeds, weather
from skylag.plans import batch, live, views
from skylag.plans import sql_views as sv
from skylag.plans.registry import query
from skylag.session import work_path
from skylag.sources import files, tables
from skylag.streaming import jobs, runs
from skylag.streaming.first_rows import first_rows

FEED_SCHEMA = T.StructType(
    [T.StructField("event_id", T.StringType()), *schemas.FEED_RECORD.fields]
)
MESSAGE_SCHEMA = "key string, value binary, topic string"


def event_stream(spark, sf, **options):
    path = f"{sf}/events.parquet"
    schema = spark.read.parquet(path).schema
    return views.event_columns(runs.file_stream(spark, path, schema, **options))


def message_stream(spark, sf):
    """The events as landed JSON messages of several topics."""
    path = work_path(spark, "messages")
    views.feed_messages(views.events(spark, sf)).write.partitionBy("topic").parquet(path)
    return spark.readStream.schema(MESSAGE_SCHEMA).parquet(path)


DECODED_SQL = f"""WITH {sv.FEED}
SELECT 'key-' || CAST(event_id AS VARCHAR) AS key, topic, flight_iata, flight_number, delay,
       CAST(event_id AS VARCHAR) AS _fetched_at FROM feed_ok WHERE decodable"""


@query("kafka_json_source", DECODED_SQL)
def kafka_json_source(spark, sf):
    decoded = feeds.decode_json(
        message_stream(spark, sf), schemas.FEED_RECORD, keep=("key", "topic")
    )
    return runs.run_bounded(
        decoded.select("key", "topic", "flight_iata", "flight_number", "delay", "_fetched_at")
    )


@query(
    "kafka_json_rejects",
    f"""WITH {sv.FEED}
    SELECT 'key-' || CAST(event_id AS VARCHAR) AS key, topic, decodable AS decoded,
      CASE WHEN NOT decodable
           THEN substr('{{"event_id":' || CAST(event_id AS VARCHAR) || ',"flight_iata":null,', 1, 25) END AS rejected,
      CASE WHEN decodable THEN delay END AS delay
    FROM feed_ok""",
)
def kafka_json_rejects(spark, sf):
    """Every message: what decoded and, from the same pass, the text of what did not."""
    rows = feeds.decode_or_reject(
        message_stream(spark, sf), schemas.FEED_RECORD, keep=("key", "topic"), observe="decoding"
    )
    return runs.run_bounded(rows.select("key", "topic", "decoded", "rejected", "delay"))


@query(
    "kafka_json_sink",
    """SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS key,
              '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type
                || '","k":' || json_extract_string(props, '$.k') || ',"note":null}' AS value,
              'topic_' || event_type AS topic
       FROM events""",
)
def kafka_json_sink(spark, sf):
    """The rows that the Kafka writer sends, with one topic per event type."""
    rows = event_stream(spark, sf).withColumn("note", F.lit(None).cast("string"))
    messages = feeds.json_messages(
        rows,
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")),
        F.concat(F.lit("topic_"), F.col("event_type")),
        ["event_id", "event_type", "k", "note"],
    )
    return runs.run_bounded(messages)


@query(
    "flatten_csv_sink",
    """SELECT event_id, event_type,
              '{"user":' || CAST(user_id AS VARCHAR) || ',"k":' || json_extract_string(props, '$.k')
                || '}' AS detail,
              '["' || event_type || '","a, b"]' AS tags
       FROM events""",
)
def flatten_csv_sink(spark, sf):
    nested = event_stream(spark, sf).select(
        "event_id", "event_type",
        F.struct(F.col("user_id").alias("user"), "k").alias("detail"),
        F.array("event_type", F.lit("a, b")).alias("tags"),
    )
    flat = feeds.nested_to_json(nested)
    return files.scan_csv(spark, runs.land(flat, "flat", "csv"), flat.schema)


OPEN_SQL = """SELECT event_id, event_type, user_id,
  CASE WHEN event_type IN ('click', 'view') THEN value END AS measured,
  CASE WHEN event_type = 'view' THEN '{"deep":[' || CAST(user_id AS VARCHAR) || ',"x"]}' END AS detail,
  CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) WHEN 'view' THEN 'word' END AS mixed,
  CASE event_type WHEN 'error' THEN '{"late field":' || CAST(user_id AS VARCHAR) || '}'
                  WHEN 'signup' THEN '{"measured":"none"}' END AS rest
FROM events"""


def open_records(rows):
    """Records as JSON whose fields differ by event type."""
    kind = F.col("event_type")
    user = F.col("user_id")

    def when(*kinds):
        return kind.isin(*kinds)

    record = F.to_json(F.struct(
        "event_id", "event_type", "user_id",
        F.when(when("click", "view"), F.col("value")).alias("measured"),
        F.when(when("view"), F.struct(F.array(user.cast("string"), F.lit("x")).alias("deep"))).alias("detail"),
    ))
    # what one declared schema cannot write: numbers and words in one field, a field of other records
    body = F.expr("substring(_record, 1, length(_record) - 1)")
    extra = (
        F.when(when("click"), F.concat(F.lit(',"mixed":'), user.cast("string")))
        .when(when("view"), F.lit(',"mixed":"word"'))
        .when(when("error"), F.concat(F.lit(',"late field":'), user.cast("string")))
        .when(when("signup"), F.lit(',"measured":"none"')).otherwise(F.lit(""))
    )
    deep = F.regexp_replace(F.concat(body, extra, F.lit("}")), r'"deep":\["(\d+)"', r'"deep":[$1')
    return rows.withColumn("_record", record).select(F.parse_json(deep).alias("record"), kind.alias("kind"))


@query("feed_open_columns", OPEN_SQL)
def feed_open_columns(spark, sf):
    """Columns as the data has them. Two kinds of records come after the schema was found: a field that
    they alone have, and a word in a number's place, are in the rest."""
    records = open_records(views.table(spark, sf, "events"))
    schema = feeds.open_schema(records.filter(~F.col("kind").isin("error", "signup")))
    return feeds.open_columns(records.select("record"), schema)


@query(
    "multi_topic_subscribe",
    f"""WITH {sv.FEED}
    SELECT topic, 'key-' || CAST(event_id AS VARCHAR) AS key FROM feed_ok
    WHERE topic IN ('EGLL', 'EDDB', 'EPWA', 'EDDF')""",
)
def multi_topic_subscribe(spark, sf):
    """Four topics out of five; the topic is a partition, so the fifth is not even listed."""
    messages = message_stream(spark, sf)
    return runs.run_bounded(
        messages.filter(F.col("topic").isin(*fixed.BOARD_TOPICS)).select("topic", "key")
    )


@query("offset_policy", "SELECT event_id, event_type FROM events")
def offset_policy(spark, sf):
    """Two runs with one checkpoint: the second one starts where the first one ended."""
    path = work_path(spark, "offsets")
    rows = event_stream(spark, sf).select("event_id", "event_type")
    for _ in range(2):
        runs.start(
            rows, f"{path}/data", f"{path}/checkpoint", **runs.BOUNDED
        ).awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{path}/data")


@query("bounded_run", "SELECT event_id, user_id, value FROM events")
def bounded_run(spark, sf):
    return runs.run_bounded(event_stream(spark, sf).select("event_id", "user_id", "value"))


@query("poll_trigger", "SELECT event_id, event_type, value FROM events")
def poll_trigger(spark, sf):
    rows = event_stream(spark, sf).select("event_id", "event_type", "value")
    return runs.poll_once(rows, processingTime="1 second")


@query(
    "stream_decode_alerts",
    f"""WITH {sv.FEED}
    SELECT 'key-' || CAST(event_id AS VARCHAR) AS key,
      CASE WHEN minutes IS NOT NULL
      THEN '[+] Delayed flight ' || f || ': ' || d || ' -> ' || a || ', delay='
           || CAST(minutes AS VARCHAR) || ' min (source=airlabs, fetched='
           || CAST(event_id AS VARCHAR) || ', date_from=None, date_to=None)'
      ELSE '[+] Flight ' || f || ': ' || d || ' -> ' || a
           || ' (no numeric delay field) (source=airlabs)' END AS line
    FROM (SELECT *, coalesce(nullif(flight_iata, ''), flight_number, flight_icao, 'unknown') AS f,
                 coalesce(nullif(dep_iata, ''), departure_iata, 'unknown') AS d,
                 coalesce(arr_iata, arrival_iata, arr, 'unknown') AS a
          FROM feed_ok WHERE decodable)""",
)
def stream_decode_alerts(spark, sf):
    return runs.run_bounded(jobs.delay_alerts(message_stream(spark, sf), keep=("key",)))


@query(
    "stream_dedup",
    f"""WITH {sv.METAR}
    SELECT DISTINCT station_id AS station, instant AS ts FROM metar WHERE instant IS NOT NULL""",
)
def stream_dedup(spark, sf):
    """Each observation arrives three times, as polls that look back do; one of them is kept."""
    observed = feeds.metar_typed(
        feeds.metar_events(views.metar(event_stream(spark, sf)), ingested_at="now")
    )
    repeated = observed.filter(F.col("ts").isNotNull()).withColumn(
        "poll", F.explode(F.sequence(F.lit(1), F.lit(3)))
    )
    kept = runs.run_bounded(jobs.drop_repeats(repeated, "station", "ts", salts=4).select("station", "ts"))
    return kept.select("station", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query(
    "stream_first_rows",
    f"""WITH {sv.METAR}
    SELECT station_id AS station, instant AS ts, 3 * count(*) - 1 AS repeats
    FROM metar WHERE instant IS NOT NULL GROUP BY ALL""",
)
def stream_first_rows(spark, sf):
    """Each observation three times, none of them too late to be the first, and how many are dropped."""
    observed = feeds.metar_typed(
        feeds.metar_events(views.metar(event_stream(spark, sf)), ingested_at="now")
    )
    repeated = observed.filter(F.col("ts").isNotNull()).withColumn(
        "poll", F.explode(F.sequence(F.lit(1), F.lit(3)))
    )
    with runs.state_on_disk(spark):
        kept = runs.run_bounded(first_rows(repeated, "station", "ts", forget="2 hours"))
    return kept.filter("is_first").select("station", F.col("ts").cast("timestamp_ntz").alias("ts"), "repeats")


# flights and observations of the events: the larger half of the numbers observes
FLIGHTS_SQL = f"""{sv.EVENTS},
flights AS (SELECT event_id AS flight, event_type AS station, ts FROM ev WHERE k < 50),
seen AS (SELECT event_type AS station, ts AS observed_at, value AS temp_c FROM ev WHERE k >= 50)"""


def flights_and_weather(rows):
    flights = rows.filter("k < 50").select(F.col("event_id").alias("flight"), F.col("event_type").alias("station"), "ts")
    return flights, rows.filter("k >= 50").select(F.col("event_type").alias("station"), "ts", F.col("value").alias("temp_c"))


def _joined(df):
    return df.select(
        "flight", "station", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "temp_c",
    )


@query(
    "flights_weather_join",
    f"""WITH {FLIGHTS_SQL}
    SELECT flight, f.station, f.ts, observed_at, temp_c FROM flights f LEFT JOIN seen s
      ON s.station = f.station AND observed_at BETWEEN f.ts - INTERVAL 30 MINUTE AND f.ts""",
)
def flights_weather_join(spark, sf):
    """Flights with the observations of the half hour before, as tables."""
    return _joined(jobs.join_recent_weather(*flights_and_weather(views.events(spark, sf)), reach="30 minutes"))


@query(
    "stream_flights_weather_join",
    f"""WITH {FLIGHTS_SQL},
    closed AS (SELECT least((SELECT max(ts) FROM flights), (SELECT max(observed_at) FROM seen))
                      - INTERVAL 2 HOUR AS until)
    SELECT flight, f.station, f.ts, observed_at, temp_c FROM flights f LEFT JOIN seen s
      ON s.station = f.station AND observed_at BETWEEN f.ts - INTERVAL 30 MINUTE AND f.ts
    WHERE observed_at IS NOT NULL OR f.ts <= (SELECT until FROM closed)""",
)
def stream_flights_weather_join(spark, sf):
    """The same as two streams: flights without weather wait until the watermark has passed them."""
    flights, _ = flights_and_weather(event_stream(spark, sf))
    _, observed = flights_and_weather(event_stream(spark, sf))
    return _joined(runs.run_bounded(jobs.join_recent_weather(flights, observed, reach="30 minutes")))


@query(
    "stream_static_weather_join",
    f"""WITH {sv.METAR},
    station_hours AS (
      SELECT event_type AS station, CAST(ts AS DATE) AS date, hour(ts) AS hour,
             avg(floor(value) / 2 - 20) AS hour_temperature,
             sum(CAST(k % 7 AS DOUBLE)) AS hour_precipitation,
             max(floor(value) + k) AS hour_wind_gusts
      FROM ev WHERE k % 3 <> 2 GROUP BY ALL)
    SELECT m.station_id AS station, m.instant AS ts, CAST(m.temp_c AS DOUBLE) AS temp_c, h.hour_temperature,
           h.hour_precipitation, h.hour_wind_gusts
    FROM metar m LEFT JOIN station_hours h ON h.station = m.station_id
         AND h.date = CAST(m.instant AS DATE) AND h.hour = hour(m.instant)""",
)
def stream_static_weather_join(spark, sf):
    """The enrich job: weather messages as a stream, hourly weather (not for every hour) as a table."""
    hours = views.hourly(spark, sf).filter("snowfall IS NOT NULL")
    shift = F.make_dt_interval(F.lit(views.WEATHER_SHIFT_DAYS))
    static = weather.station_hour(hours.withColumn("time", F.col("time") + shift))
    path = work_path(spark, "enrich")
    tables.replace_table(
        static.withColumn(batch.YEAR, F.year("date")), f"{path}/tables/{batch.STATION_HOUR}", (batch.YEAR,)
    )
    messages = feeds.weather_messages(feeds.metar_events(views.metar(event_stream(spark, sf)), ingested_at="now"))
    live.enrich(messages, f"{path}/out", f"{path}/tables", f"{path}/state", **runs.BOUNDED).awaitTermination()
    return spark.read.parquet(f"{path}/out").select(
        "station", F.col("ts").cast("timestamp_ntz").alias("ts"), "temp_c",
        "hour_temperature", "hour_precipitation", "hour_wind_gusts",
    )


@query(
    "stream_hourly_agg",
    f"""WITH {sv.METAR},
    seen AS (SELECT station_id AS station, instant, CAST(temp_c AS DOUBLE) AS t,
                    CAST(wind_speed_kt AS DOUBLE) AS w FROM metar WHERE instant IS NOT NULL)
    SELECT * FROM (
      SELECT station, date_trunc('hour', instant) AS hour_start, count(*) AS observations,
             avg(t) AS avg_temp_c, min(t) AS min_temp_c, max(t) AS max_temp_c,
             max(w) AS max_wind_speed_kt
      FROM seen GROUP BY 1, 2)
    WHERE hour_start + INTERVAL 1 HOUR <= (SELECT max(instant) FROM seen) - INTERVAL 2 HOUR""",
)
def stream_hourly_agg(spark, sf):
    """Closed hours only: the hours after the watermark wait for later observations."""
    observed = feeds.metar_typed(
        feeds.metar_events(views.metar(event_stream(spark, sf)), ingested_at="now")
    )
    hours = runs.run_bounded(jobs.hourly_statistics(observed.filter(F.col("ts").isNotNull())))
    return hours.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


@query(
    "hourly_agg_batch",
    f"""WITH {sv.METAR}
    SELECT station_id AS station, date_trunc('hour', instant) AS hour_start,
           count(*) AS observations, avg(CAST(temp_c AS DOUBLE)) AS avg_temp_c,
           min(CAST(temp_c AS DOUBLE)) AS min_temp_c, max(CAST(temp_c AS DOUBLE)) AS max_temp_c,
           max(CAST(wind_speed_kt AS DOUBLE)) AS max_wind_speed_kt
    FROM metar WHERE instant IS NOT NULL GROUP BY ALL""",
)
def hourly_agg_batch(spark, sf):
    """The same statistics over a table: every hour is given out."""
    observed = feeds.metar_typed(
        feeds.metar_events(views.metar(views.events(spark, sf)), ingested_at="now")
    )
    hours = jobs.hourly_statistics(observed.filter(F.col("ts").isNotNull()))
    return hours.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


@query(
    "weather_messages",
    f"""WITH {sv.METAR}
    SELECT coalesce(station_id, 'None') || '|' || observation_time AS key, 'weather' AS topic,
           station_id, observation_hour, raw_text AS full_raw_text,
           '[' || coalesce(station_id, 'None') || '] ' || observation_time || ' ' || temp_c
             || 'C ' || flight_category AS line
    FROM metar""",
)
def weather_messages(spark, sf):
    """Observations to messages and back, as a producer and a consumer do it."""
    events = feeds.metar_events(views.metar(event_stream(spark, sf)), ingested_at="now")
    messages = runs.run_bounded(feeds.weather_messages(events))
    decoded = feeds.decode_json(messages, schemas.METAR_EVENT, keep=("key", "topic"))
    return decoded.select(
        "key", "topic", "station_id", "observation_hour",
        F.col("full_record")["raw_text"].alias("full_raw_text"), text.metar_line().alias("line"),
    )


@query(
    "delay_messages",
    f"""WITH {sv.FEED}
    SELECT coalesce(nullif(flight_iata, ''), flight_icao, flight_number, 'none') AS key,
           'delays' AS topic, flight_iata, delay, 'airlabs' AS _source, '7' AS _fetched_at
    FROM feed, range(CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 2 ELSE 1 END)""",
)
def delay_messages(spark, sf):
    """Feed payloads to messages with provenance and back."""
    payloads = views.feed_payloads(event_stream(spark, sf))
    messages = runs.run_bounded(feeds.delay_messages(payloads, fetched_at=F.lit(7)))
    decoded = feeds.decode_json(messages, schemas.FEED_RECORD, keep=("key", "topic"))
    return decoded.select("key", "topic", "flight_iata", "delay", "_source", "_fetched_at")
