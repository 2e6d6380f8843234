"""Checked queries: files, sinks, feeds, boards, positions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import fixed, schemas
from skylag.functions import keys, text
from skylag.operators import feeds, weather
from skylag.plans import sql_views as sv
from skylag.plans import views
from skylag.plans.registry import query
from skylag.session import work_path, written
from skylag.sources import archives, files, stations, tables
from skylag.streaming.jobs import board_lines

ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)
ALL_ORDERS = "SELECT * FROM orders"

# --- files -----------------------------------------------------------------------------------


@query("csv_scan_typed", "SELECT * FROM lineitem")
def csv_scan_typed(spark, sf):
    lines = views.table(spark, sf, "lineitem")
    path = work_path(spark, "csv")
    files.write_csv(lines, path)
    return files.scan_csv(spark, path, lines.schema)


@query(
    "csv_bad_lines",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 5 THEN o_custkey END AS o_custkey,
              CASE WHEN o_orderkey % 89 <> 3 THEN o_totalprice END AS o_totalprice,
              o_orderkey % 97 = 5 OR o_orderkey % 89 = 3 AS bad
       FROM orders""",
)
def csv_bad_lines(spark, sf):
    """Damaged cells: good rows and bad lines both come back. A zero fraction is no damage."""
    key = F.col("o_orderkey")
    cells = views.table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.when(key % 97 == 5, "x").otherwise(""), "o_custkey", F.when(key % 2 == 0, ".0").otherwise(""))
        .alias("o_custkey"),
        F.when(key % 89 == 3, "7-5").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
    )
    path = work_path(spark, "damaged")
    files.write_csv(cells, path)
    schema = T.StructType([ORDERS["o_orderkey"], ORDERS["o_custkey"], ORDERS["o_totalprice"]])
    rows = files.scan_csv(spark, path, schema, bad_lines="bad_line")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", F.isnotnull("bad_line").alias("bad"))


@query("bz2_csv_scan", ALL_ORDERS)
def bz2_csv_scan(spark, sf):
    path = work_path(spark, "bz2")
    files.write_csv(views.table(spark, sf, "orders"), path, compression="bzip2")
    return files.scan_csv(spark, f"{path}/*.csv.bz2", ORDERS)


@query("yearly_union_scan", ALL_ORDERS)
def yearly_union_scan(spark, sf):
    """Two files with their columns in another order, one without the priority column's place."""
    orders = views.table(spark, sf, "orders")
    early, late = work_path(spark, "early"), work_path(spark, "late")
    year = F.year("o_orderdate")
    files.write_csv(orders.filter(year < 1998), early)
    files.write_csv(orders.filter(year >= 1998).select(*reversed(orders.columns)), late)
    return files.scan_yearly(spark, [early, late], ORDERS)


@query(
    "parquet_scan",
    "SELECT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS day FROM lineitem",
)
def parquet_scan(spark, sf):
    """A whole table, of which the files give only the columns that are asked for."""
    lines = files.scan_parquet(spark, f"{sf}/lineitem.parquet")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("day"))


@query(
    "parquet_sink_overwrite",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderdate AS DATE) AS day,
              CASE WHEN year(o_orderdate) >= 1998 THEN 'second'
                   WHEN o_orderdate >= DATE '1997-02-10' AND o_orderdate < DATE '1997-04-01' THEN 'third'
                   ELSE 'first' END AS run
       FROM orders""",
)
def parquet_sink_overwrite(spark, sf):
    """Write all years, then replace some of them, and then a part of one; all else stays."""
    path = work_path(spark, "table")
    rows = views.table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_orderdate").cast("date").alias("day")
    )
    spring = F.col("day").between("1997-02-10", "1997-03-31")
    for run, part in (("first", F.lit(True)), ("second", F.col("year") >= 1998), ("third", spring)):
        tables.replace_table(rows.filter(part).withColumn("run", F.lit(run)), path, ("year",), within="day")
    return tables.read_table(spark, path).select("o_orderkey", "year", "day", "run")


@query(
    "station_dim_load",
    """SELECT s_name AS icao, 'Station ' || CAST(s_nationkey AS VARCHAR) AS airport,
              floor(s_acctbal) / 128 AS latitude, CAST(s_nationkey AS DOUBLE) AS longitude
       FROM supplier""",
)
def station_dim_load(spark, sf):
    path = work_path(spark, "stations")
    listed = views.table(spark, sf, "supplier").select(
        F.col("s_name").alias("icao"),
        F.concat(F.lit("Station "), F.col("s_nationkey").cast("string")).alias("airport"),
        (F.floor("s_acctbal") / 128).alias("latitude"),
        F.col("s_nationkey").alias("longitude"),
    )
    files.write_csv(listed, path)
    return stations.load_stations(spark, path)


@query(
    "station_list_parse",
    """SELECT station, count(*) AS n
       FROM (SELECT trim(unnest(string_split_regex(text, '[,\\n\\r]')), e' \\t') AS station
             FROM documents)
       WHERE station <> '' GROUP BY station""",
)
def station_list_parse(spark, sf):
    codes = stations.station_codes(views.table(spark, sf, "documents").select("text"), "text")
    return codes.groupBy("station").agg(F.count("*").alias("n"))


@query(
    "columnar_json_to_rows",
    """SELECT vec_id, strftime(TIMESTAMP '2025-01-01' + to_hours(i), '%Y-%m-%dT%H:%M') AS time,
              CAST(embedding[i + 1] AS DOUBLE) AS temperature_2m,
              CASE WHEN i <= label THEN CAST(embedding[i + 1] AS DOUBLE) END
                AS relative_humidity_2m,
              CAST(embedding[i + 1] AS DOUBLE) AS wind_speed_10m,
              CAST(NULL AS DOUBLE) AS snowfall
       FROM (SELECT vec_id, label, embedding, CAST(unnest(range(len(embedding))) AS INTEGER) AS i
             FROM embeddings WHERE label <> 9)""",
)
def columnar_json_to_rows(spark, sf):
    return weather.payload_rows(views.payload_texts(spark, sf)).select(
        "vec_id", "time", "temperature_2m", "relative_humidity_2m", "wind_speed_10m", "snowfall"
    )


PAYLOAD_SQL = """hours AS (
  SELECT vec_id, s_name AS icao, 'Station ' || CAST(s_nationkey AS VARCHAR) AS airport,
         TIMESTAMP '2025-01-01' + to_hours(i) AS time,
         CAST(embedding[i + 1] AS DOUBLE) AS temperature_2m
  FROM (SELECT vec_id, embedding, CAST(unnest(range(len(embedding))) AS INTEGER) AS i
        FROM embeddings WHERE label <> 9)
  JOIN supplier ON s_suppkey = vec_id % 10 + 1)"""


def _payload_hours(spark, sf):
    suppliers = views.table(spark, sf, "supplier")
    stations_ = suppliers.select(
        F.col("s_name").alias("icao"),
        F.concat(F.lit("Station "), F.col("s_nationkey").cast("string")).alias("airport"),
        F.lit(50.0).alias("latitude"), F.lit(20.0).alias("longitude"),
    )
    named = views.payload_texts(spark, sf).join(
        suppliers.select(F.col("s_name").alias("icao"), "s_suppkey"),
        F.col("s_suppkey") == F.col("vec_id") % 10 + 1,
    )
    return weather.payload_hourly(named.select("vec_id", "icao", "payload"), stations_)


@query("payload_hourly_weather", f"WITH {PAYLOAD_SQL} SELECT * FROM hours")
def payload_hourly_weather(spark, sf):
    return _payload_hours(spark, sf).select(
        "vec_id", "icao", "airport", F.col("time").cast("timestamp_ntz").alias("time"), "temperature_2m"
    )


@query(
    "payload_station_days",
    f"""WITH {PAYLOAD_SQL}
    SELECT icao, CAST(time AS DATE) AS date, round(avg(temperature_2m), 6) AS mean,
           count(*) AS hours FROM hours GROUP BY ALL""",
)
def payload_station_days(spark, sf):
    """From payloads to the keyed hours that the day tables are made of."""
    keyed = weather.hourly_keyed(_payload_hours(spark, sf))
    return keyed.groupBy("icao", "date").agg(
        F.round(F.avg("temperature_2m"), 6).alias("mean"), F.count("*").alias("hours")
    )


BOARD_COLUMNS = ", ".join(schemas.BOARD_ROW.fieldNames())


@query("board_json_flatten", f"WITH {sv.BOARD} SELECT * FROM board")
def board_json_flatten(spark, sf):
    return feeds.board_rows(views.boards(spark, sf, dealt=False))


@query("csv_sink", f"WITH {sv.BOARD} SELECT {BOARD_COLUMNS} FROM board")
def csv_sink(spark, sf):
    path = work_path(spark, "board")
    rows = feeds.board_rows(views.boards(spark, sf)).select(*schemas.BOARD_ROW.fieldNames())
    files.write_csv(rows, path)
    return files.scan_csv(spark, path, schemas.BOARD_ROW)


@query(
    "csv_sink_line_ends",
    """SELECT doc_id, text, source || '\n"' || lang || '",' || chr(13) || chr(10) AS tag FROM documents""",
)
def csv_sink_line_ends(spark, sf):
    """Whole texts with line ends, quotes and separators in their cells, through a CSV and back."""
    path = work_path(spark, "texts")
    rows = views.table(spark, sf, "documents").select(
        "doc_id", "text", F.concat("source", F.lit('\n"'), "lang", F.lit('",\r\n')).alias("tag")
    )
    files.write_csv(rows, path)
    return files.scan_csv(spark, path, rows.schema)


@query(
    "metar_csv_decode",
    f"""WITH {sv.METAR}
    SELECT station_id, observation_time, raw_text, temp_c,
           wind_gust_kt, flight_category, elevation_m FROM metar""",
)
def metar_csv_decode(spark, sf):
    path = work_path(spark, "metar")
    files.write_csv(views.metar(views.events(spark, sf)), path)
    decoded = files.scan_csv(spark, path, schemas.METAR_RAW)
    return decoded.select(
        "station_id", "observation_time", "raw_text", "temp_c", "wind_gust_kt", "flight_category", "elevation_m",
    )


@query(
    "metar_csv_documents",
    f"""WITH {sv.EVENTS}
    SELECT CASE WHEN event_type = 'view' THEN 'VI,"EW' ELSE event_type END AS station_id,
           strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS observation_time, CAST(k AS VARCHAR) AS temp_c,
           CAST(event_id AS VARCHAR) AS raw_text, CAST(NULL AS VARCHAR) AS wind_gust_kt,
           'last' AS sky
    FROM ev WHERE event_type <> 'error'
    UNION ALL
    SELECT CAST(event_id AS VARCHAR), NULL, CAST(k AS VARCHAR), NULL, NULL, NULL
    FROM ev WHERE event_type <> 'error'""",
)
def metar_csv_documents(spark, sf):
    """Documents with a header each, as polls return them."""
    records = feeds.metar_records(views.metar_documents(views.events(spark, sf)))
    return records.select(
        "station_id", "observation_time", "temp_c", "raw_text", "wind_gust_kt",
        F.col("full_record")["sky"].alias("sky"),
    )


TSV_SQL = f"""WITH {sv.EVENTS},
log AS (
  SELECT CASE WHEN event_type = 'click' THEN '' ELSE CAST(event_id AS VARCHAR) END
           AS GLOBALEVENTID,
         strftime(ts, '%Y%m%d') AS SQLDATE, strftime(ts, '%Y%m') AS MonthYear,
         CAST(k AS VARCHAR) AS "Year", '' AS FractionDate, 'C1' AS Actor1Code,
         CASE WHEN event_type = 'purchase' THEN e'A\\t" ' || CAST(k AS VARCHAR)
              ELSE CAST(k AS VARCHAR) END AS Actor1Name,
         'v7' AS Actor1CountryCode, 'v58' AS ActionGeo_FeatureID,
         strftime(ts, '%Y%m%d') AS DATEADDED,
         CASE WHEN event_type = 'click' AND k < 30 THEN ''
              ELSE 'http://x/' || CAST(event_id AS VARCHAR) END AS SOURCEURL
  FROM ev WHERE event_type <> 'error'
)"""
TSV_COLUMNS = (
    "GLOBALEVENTID", "SQLDATE", "MonthYear", "Year", "FractionDate", "Actor1Code", "Actor1Name",
    "Actor1CountryCode", "ActionGeo_FeatureID", "DATEADDED", "SOURCEURL",
)


def _event_log(spark, sf):
    """The log as files of three kinds in one folder, each read by its suffix."""
    path = work_path(spark, "tsv")
    events = views.events(spark, sf)
    for n, kind in enumerate(("none", "gzip", "bzip2")):
        part = views.spread(events.filter(F.pmod("event_id", F.lit(3)) == n), "event_id", "user_id")
        part = views.event_log_lines(part)
        part.write.mode("append").text(path, compression=kind)
    return archives.scan_event_log(spark, path)


@query("tsv61_scan", f"{TSV_SQL} SELECT * FROM log")
def tsv61_scan(spark, sf):
    return _event_log(spark, sf).select(*TSV_COLUMNS)


@query(
    "event_key",
    f"""{TSV_SQL} SELECT coalesce(nullif(GLOBALEVENTID, ''), nullif(SOURCEURL, ''), 'unknown')
    AS key, SQLDATE FROM log""",
)
def event_key(spark, sf):
    return _event_log(spark, sf).select(keys.event_key().alias("key"), "SQLDATE")


@query(
    "envelope_wrap",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key,
              '{"source":"gdelt","format":"gdelt_events","record":{"o_orderkey":'
                || CAST(o_orderkey AS VARCHAR) || ',"o_orderstatus":"' || o_orderstatus
                || '","o_orderpriority":' || CASE WHEN o_orderpriority = '5-LOW' THEN 'null'
                     ELSE '"' || o_orderpriority || '"' END || '}}' AS value
       FROM orders""",
)
def envelope_wrap(spark, sf):
    record = F.struct(
        "o_orderkey", "o_orderstatus",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return views.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        feeds.envelope(fixed.EVENT_LOG_SOURCE, fixed.EVENT_LOG_FORMAT, record).alias("value"),
    )


@query(
    "event_log_messages",
    f"""{TSV_SQL} SELECT coalesce(nullif(GLOBALEVENTID, ''), nullif(SOURCEURL, ''), 'unknown')
    AS key, 'gdelt_raw' AS topic, 'gdelt' AS source, SQLDATE AS record_date,
    Actor1Name AS record_name FROM log""",
)
def event_log_messages(spark, sf):
    messages = feeds.event_log_messages(_event_log(spark, sf))
    return messages.select(
        "key", "topic",
        F.get_json_object("value", "$.source").alias("source"),
        F.get_json_object("value", "$.record.SQLDATE").alias("record_date"),
        F.get_json_object("value", "$.record.Actor1Name").alias("record_name"),
    )


# --- feed --------------------------------------------------------------------------------------


@query(
    "feed_payload_normalise",
    f"""WITH {sv.FEED}
    SELECT event_id, flight_iata, flight_icao, flight_number, dep_iata, delay, dep_delay,
           arrival_delay
    FROM feed, range(CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 2 ELSE 1 END)""",
)
def feed_payload_normalise(spark, sf):
    records = feeds.feed_records(views.feed_payloads(views.events(spark, sf)))
    return feeds.record_columns(records).select(
        "event_id", "flight_iata", "flight_icao", "flight_number", "dep_iata", "delay",
        "dep_delay", "arrival_delay",
    )


@query(
    "provenance_enrich",
    f"""WITH {sv.FEED}
    SELECT event_id, flight_iata, 'airlabs' AS _source, true AS fetched,
           60 AS _airlabs_delay_threshold, 'departures' AS _airlabs_type FROM feed""",
)
def provenance_enrich(spark, sf):
    enriched = views.flights_feed(views.events(spark, sf)).withColumns(feeds.provenance())
    return enriched.select(
        "event_id", "flight_iata", "_source", (F.col("_fetched_at") > 0).alias("fetched"),
        "_airlabs_delay_threshold", "_airlabs_type",
    )


@query(
    "delay_threshold_filter",
    """SELECT event_id, value AS delay, event_type FROM events
       WHERE value >= 60 AND event_type = 'purchase'""",
)
def delay_threshold_filter(spark, sf):
    e = views.table(spark, sf, "events").select("event_id", F.col("value").alias("delay"), "event_type")
    return feeds.delayed_at_least(e, fixed.FEED_THRESHOLD_MINUTES, "purchase", "delay", "event_type")


@query(
    "alert_format",
    f"""WITH {sv.FEED}
    SELECT event_id,
      CASE WHEN minutes IS NOT NULL
      THEN '[+] Delayed flight ' || f || ': ' || d || ' -> ' || a || ', delay='
           || CAST(minutes AS VARCHAR) || ' min (source=unknown, fetched=None, date_from=None, '
           || 'date_to=None)'
      ELSE '[+] Flight ' || f || ': ' || d || ' -> ' || a
           || ' (no numeric delay field) (source=unknown)' END AS line
    FROM (SELECT *, coalesce(nullif(flight_iata, ''), flight_number, flight_icao, 'unknown') AS f,
                 coalesce(nullif(dep_iata, ''), departure_iata, 'unknown') AS d,
                 coalesce(arr_iata, arrival_iata, arr, 'unknown') AS a FROM feed_ok)""",
)
def alert_format(spark, sf):
    feed = views.flights_feed(views.events(spark, sf)).withColumns(
        {"_source": F.lit(None).cast("string"), "_fetched_at": F.lit(None).cast("string")}
    )
    return feed.select("event_id", text.delay_alert().alias("line"))


@query(
    "metar_line_format",
    f"""WITH {sv.METAR}
    SELECT '[' || coalesce(station_id, 'None') || '] ' || observation_time || ' ' || temp_c
           || 'C ' || flight_category AS line FROM metar""",
)
def metar_line_format(spark, sf):
    return views.metar(views.events(spark, sf)).select(text.metar_line().alias("line"))


@query(
    "metar_event_project",
    f"""WITH {sv.METAR}
    SELECT 'aviationweather.gov' AS source, 'metars' AS data_source, 'now' AS ingested_at,
           station_id, observation_time, observation_date, observation_hour, raw_text,
           '50.5' AS latitude, '10.25' AS longitude, temp_c, dewpoint_c, wind_dir_degrees,
           wind_speed_kt, wind_gust_kt, visibility_statute_mi, '29.92' AS altim_in_hg,
           sea_level_pressure_mb, flight_category, 'METAR' AS metar_type, elevation_m,
           station_id || '|' || coalesce(observation_date, '') || '|'
             || coalesce(observation_hour, '') AS feature_join_key,
           raw_text AS full_raw_text, 16 AS full_size
    FROM metar""",
)
def metar_event_project(spark, sf):
    events = feeds.metar_events(views.metar(views.events(spark, sf)), ingested_at="now")
    return events.withColumns(
        {
            "full_raw_text": F.col("full_record")["raw_text"],
            "full_size": F.size("full_record"),
        }
    ).drop("full_record")


# --- boards and positions -----------------------------------------------------------------------------


@query(
    "topic_route",
    f"""WITH {sv.BOARD}
    SELECT airport AS topic, direction AS key,
           '[' || airport || '] ' || CASE WHEN direction = 'arrival'
             THEN 'PRZYLOT | Lot: ' || flight_number || ' z ' || origin_iata
             ELSE 'ODLOT  | Lot: ' || flight_number || ' do ' || coalesce(dest_iata, 'None') END
           || ' | Status: ' || status AS line
    FROM board""",
)
def topic_route(spark, sf):
    rows = feeds.board_rows(views.boards(spark, sf))
    messages = written(feeds.board_messages(rows, "airport"), "board-messages")
    return board_lines(messages, keep=("topic", "key"))


POSITION_COLUMNS = ", ".join([*fixed.POSITION_FIELDS, "timestamp"])


@query("position_project", f"WITH {sv.POSITIONS} SELECT {POSITION_COLUMNS} FROM live")
def position_project(spark, sf):
    live = views.live_positions(spark, sf)
    return feeds.positions(live, F.col("ts").cast("timestamp_ntz"))


@query(
    "bbox_filter",
    f"""WITH {sv.POSITIONS} SELECT id, latitude, longitude FROM live
    WHERE latitude BETWEEN 49 AND 55 AND longitude BETWEEN 14 AND 24""",
)
def bbox_filter(spark, sf):
    return feeds.in_box(views.live_positions(spark, sf)).select("id", "latitude", "longitude")


@query(
    "airline_or_flight_filter",
    f"""WITH {sv.POSITIONS}
    SELECT callsign, aircraft, origin, destination, altitude_ft, speed_kt, latitude AS lat,
           longitude AS lon FROM live WHERE airline = 'PUR'""",
)
def airline_filter(spark, sf):
    return feeds.airline_positions(views.live_positions(spark, sf), "PUR")


@query(
    "flight_lookup",
    f"""WITH {sv.POSITIONS}
    SELECT id, callsign, timestamp FROM live
    WHERE (callsign = 'CS7' OR id = 'CS7') AND airline = 'VIE' ORDER BY timestamp, id LIMIT 1""",
)
def flight_lookup(spark, sf):
    found = feeds.find_flight(views.live_positions(spark, sf), "CS7", "VIE", "ts", "id")
    return found.select("id", "callsign", F.col("ts").cast("timestamp_ntz").alias("timestamp"))
