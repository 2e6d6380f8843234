"""The views of `views.py` once more, as SQL text for the checking engine.

Written by hand from the same definitions, not generated from the Spark code.
"""

from __future__ import annotations

FACTS = """
facts AS (
  SELECT CAST(l_shipdate AS DATE) AS date, n_name AS ENTITY_NAME, r_name AS ENTITY_TYPE,
         nullif(CAST(l_quantity AS BIGINT) - 1, 49) AS FLT_ERT_1,
         floor(l_extendedprice) AS DLY_ERT_1,
         l_returnflag || l_linestatus AS flags,
         CASE WHEN l_discount >= CAST(0.03 AS DOUBLE) THEN CAST(l_quantity AS BIGINT) END AS dly,
         CASE WHEN l_discount >= CAST(0.06 AS DOUBLE) THEN CAST(l_quantity AS BIGINT) END AS dly15
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
prepared AS (
  SELECT date, ENTITY_NAME, ENTITY_TYPE, FLT_ERT_1, DLY_ERT_1,
         CASE WHEN flags = 'AF' THEN DLY_ERT_1 ELSE 0.0 END AS W,
         CASE WHEN flags = 'AO' THEN DLY_ERT_1 ELSE 0.0 END AS D,
         CASE WHEN flags = 'NF' THEN DLY_ERT_1 ELSE 0.0 END AS I,
         CASE WHEN flags = 'NO' THEN DLY_ERT_1 ELSE 0.0 END AS N,
         CASE WHEN flags = 'RF' THEN DLY_ERT_1 ELSE 0.0 END AS C,
         CASE WHEN flags = 'RO' THEN DLY_ERT_1 ELSE 0.0 END AS P,
         coalesce(dly, 0) AS dly, coalesce(dly15, 0) AS dly15
  FROM facts
)"""


def rollup(keys: str, group: str = "", source: str = "prepared") -> str:
    """The seven sums, ratio and rest per key list."""
    return f"""
  SELECT *, CASE WHEN total_flights > 0 THEN total_delay / total_flights ELSE 0.0 END
            AS delay_per_flight,
         total_delay - (weather_delay + industrial_delay + atc_delay) AS other_delay
  FROM (SELECT {keys}, CAST(sum(FLT_ERT_1) AS BIGINT) AS total_flights,
               sum(DLY_ERT_1) AS total_delay, sum(W + D) AS weather_delay,
               sum(I + N) AS industrial_delay, sum(C) AS atc_delay,
               CAST(sum(dly) AS BIGINT) AS delayed_flights,
               CAST(sum(dly15) AS BIGINT) AS delayed_flights_15
        FROM {source} GROUP BY {group or keys})"""


DAILY = f"{FACTS},\ndaily AS ({rollup('date, ENTITY_NAME, ENTITY_TYPE')})"

EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

HOURLY = f"""{EVENTS},
hourly AS (
  SELECT event_type AS icao, 'Station ' || event_type AS airport,
         ts - INTERVAL 9496 DAY AS time,
         floor(value) / 2 - 20 AS temperature_2m,
         CAST(nullif(k, 0) AS DOUBLE) AS relative_humidity_2m,
         CAST(k AS DOUBLE) / 4 - 10 AS dew_point_2m,
         CAST(k % 7 AS DOUBLE) AS precipitation,
         CAST(k % 5 AS DOUBLE) AS rain,
         CAST(nullif(k % 3, 2) AS DOUBLE) AS snowfall,
         CAST(nullif(k, 50) AS DOUBLE) AS cloud_cover,
         CAST(k AS DOUBLE) / 2 + 1000 AS pressure_msl,
         CAST(k AS DOUBLE) / 2 + 990 AS surface_pressure,
         floor(value) / 4 AS wind_speed_10m,
         floor(value) + k AS wind_gusts_10m
  FROM ev
)"""

STATION_DAYS = f"""{HOURLY},
station_days AS (
  SELECT icao, airport, CAST(time AS DATE) AS date,
         avg(temperature_2m) AS avg_temperature,
         avg(relative_humidity_2m) AS avg_humidity,
         avg(dew_point_2m) AS avg_dew_point,
         sum(precipitation) AS total_precipitation,
         sum(rain) AS total_rain,
         sum(snowfall) AS total_snowfall,
         avg(cloud_cover) AS avg_cloud_cover,
         avg(pressure_msl) AS avg_pressure_msl,
         avg(surface_pressure) AS avg_surface_pressure,
         avg(wind_speed_10m) AS avg_wind_speed,
         max(wind_gusts_10m) AS max_wind_gusts,
         min(temperature_2m) AS min_temperature,
         max(temperature_2m) AS max_temperature
  FROM hourly GROUP BY 1, 2, 3
)"""

REGION_DAYS = f"""{STATION_DAYS},
region_days AS (
  SELECT date,
         avg(avg_temperature) AS avg_temperature_europe,
         avg(avg_humidity) AS avg_humidity_europe,
         avg(total_precipitation) AS avg_precipitation_europe,
         avg(total_rain) AS avg_rain_europe,
         avg(total_snowfall) AS avg_snowfall_europe,
         avg(avg_cloud_cover) AS avg_cloud_cover_europe,
         avg(avg_wind_speed) AS avg_wind_speed_europe,
         max(max_wind_gusts) AS max_wind_gusts_europe
  FROM station_days GROUP BY date
)"""

NATION_CASE = """CASE WHEN contains(lower(trim(ENTITY_NAME)), '_12') THEN 'view'
              WHEN contains(lower(trim(ENTITY_NAME)), '_1') THEN 'click'
              WHEN contains(lower(trim(ENTITY_NAME)), '_20')
                OR contains(lower(trim(ENTITY_NAME)), '_21') THEN 'error'
              WHEN contains(lower(trim(ENTITY_NAME)), '_3') THEN 'purchase'
              WHEN contains(lower(trim(ENTITY_NAME)), '_4') THEN 'nowhere' END"""
NATION_CASE_STRICT = """CASE WHEN contains(lower(trim(ENTITY_NAME)), '_1') THEN 'click'
              WHEN contains(lower(trim(ENTITY_NAME)), '_20')
                OR contains(lower(trim(ENTITY_NAME)), '_21') THEN 'error'
              WHEN contains(lower(trim(ENTITY_NAME)), '_12') THEN 'view'
              WHEN contains(lower(trim(ENTITY_NAME)), '_3') THEN 'purchase'
              WHEN contains(lower(trim(ENTITY_NAME)), '_4') THEN 'nowhere' END"""

FEATURES = f"""{DAILY},
{REGION_DAYS.lstrip()},
assigned AS (SELECT *, {NATION_CASE} AS weather_station_icao FROM daily),
joined AS (
  SELECT a.*, s.airport AS weather_station_name,
         s.* EXCLUDE (icao, airport, date), r.* EXCLUDE (date)
  FROM assigned a
  LEFT JOIN station_days s ON s.date = a.date AND s.icao = a.weather_station_icao
  LEFT JOIN region_days r ON r.date = a.date
),
features AS (
  SELECT *,
         CASE WHEN weather_station_name IS NOT NULL THEN 'entity_station'
              WHEN weather_station_icao IS NOT NULL THEN 'station_missing_weather'
              ELSE 'europe_fallback' END AS weather_match_level,
         coalesce(avg_temperature, avg_temperature_europe) AS feature_temperature,
         coalesce(avg_humidity, avg_humidity_europe) AS feature_humidity,
         coalesce(total_precipitation, avg_precipitation_europe) AS feature_precipitation,
         coalesce(total_rain, avg_rain_europe) AS feature_rain,
         coalesce(total_snowfall, avg_snowfall_europe) AS feature_snowfall,
         coalesce(avg_cloud_cover, avg_cloud_cover_europe) AS feature_cloud_cover,
         coalesce(avg_wind_speed, avg_wind_speed_europe) AS feature_wind_speed,
         coalesce(max_wind_gusts, max_wind_gusts_europe) AS feature_wind_gusts
  FROM joined
)"""

METAR = f"""{EVENTS},
metar AS (
  SELECT ev.*,
         CASE WHEN event_type <> 'purchase' OR k < 90 THEN event_type END AS station_id,
         CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00'
              WHEN event_type = 'signup' THEN CASE WHEN k < 50 THEN 'not a time' ELSE '' END
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS observation_time,
         CASE WHEN event_type <> 'signup' THEN strftime(ts, '%Y-%m-%d') END AS observation_date,
         CASE WHEN event_type <> 'signup'
              THEN strftime(ts, '%Y-%m-%dT%H:00:00')
                   || CASE WHEN event_type = 'error' THEN '+02:00' ELSE '+00:00' END
         END AS observation_hour,
         CASE WHEN event_type = 'error' THEN date_trunc('second', ts) - INTERVAL 2 HOUR
              WHEN event_type <> 'signup' THEN date_trunc('second', ts) END AS instant,
         upper(event_type) || ' ' || CAST(event_id AS VARCHAR) AS raw_text,
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS temp_c,
         CAST(k AS VARCHAR) AS dewpoint_c,
         CAST((k * 36) % 360 AS VARCHAR) AS wind_dir_degrees,
         CAST(k % 40 AS VARCHAR) AS wind_speed_kt,
         CASE WHEN k >= 50 THEN CAST(k % 60 AS VARCHAR) END AS wind_gust_kt,
         CASE WHEN k % 2 = 0 THEN '6+' ELSE '3' END AS visibility_statute_mi,
         CASE WHEN k <> 7 THEN CAST(k + 980 AS VARCHAR) END AS sea_level_pressure_mb,
         CASE WHEN value < 20 THEN 'VFR' ELSE 'IFR' END AS flight_category,
         CAST(user_id AS VARCHAR) AS elevation_m
  FROM ev
)"""

FEED = f"""{EVENTS},
feed AS (
  SELECT event_id, event_type, k,
         CASE WHEN event_type = 'click' THEN ''
              WHEN event_type IN ('purchase', 'signup') THEN 'FL' || CAST(user_id AS VARCHAR)
         END AS flight_iata,
         CASE WHEN event_type = 'click' THEN 'IC' || CAST(user_id AS VARCHAR) END AS flight_icao,
         CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) END AS flight_number,
         CASE WHEN event_type = 'error' THEN '' ELSE 'WAW' END AS dep_iata,
         CASE WHEN event_type = 'error' AND k >= 30 THEN 'D' || CAST(k AS VARCHAR)
         END AS departure_iata,
         CASE WHEN event_type = 'error' AND k >= 20 THEN 'FRA' END AS arr_iata,
         CASE WHEN event_type = 'error' AND k >= 10 THEN 'MUC' END AS arrival_iata,
         CASE WHEN event_type = 'view' THEN 'CDG' END AS arr,
         CASE event_type WHEN 'click' THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.7'
              WHEN 'view' THEN '0' WHEN 'purchase' THEN 'x' WHEN 'signup' THEN '' END AS delay,
         CASE event_type WHEN 'view' THEN CAST(k AS VARCHAR) WHEN 'signup' THEN 'inf'
         END AS dep_delay,
         CASE WHEN event_type = 'purchase'
              THEN '-' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.9'
         END AS arrival_delay,
         CASE WHEN event_type IN ('signup', 'view') THEN '0' END AS delay_minutes,
         CAST(floor(value) AS BIGINT) AS whole,
         CASE event_type WHEN 'click' THEN 'EGLL' WHEN 'view' THEN 'EDDB' WHEN 'error' THEN 'EPWA'
              WHEN 'purchase' THEN 'EDDF' ELSE 'other' END AS topic
  FROM ev
),
feed_ok AS (
  SELECT *, coalesce(CASE WHEN event_type = 'click' THEN nullif(whole, 0) END,
                     CASE WHEN event_type = 'view' THEN nullif(k, 0) END,
                     CASE WHEN event_type = 'purchase' THEN nullif(-whole, 0) END,
                     CASE WHEN event_type IN ('signup', 'view') THEN 0 END) AS minutes,
         NOT (event_type = 'error' AND k < 10) AS decodable
  FROM feed
)"""

BOARD = """
board_sides AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, direction,
         CAST(epoch(o_orderdate) AS BIGINT) + (o_custkey % 1440) * 60
           + CASE WHEN direction = 'departure' THEN 60 ELSE 0 END AS secs
  FROM orders, (VALUES ('arrival'), ('departure')) AS d(direction)
  WHERE direction = 'arrival' OR o_orderstatus <> 'P'
),
board AS (
  SELECT o_orderkey,
         CASE o_custkey % 4 WHEN 0 THEN 'EGLL' WHEN 1 THEN 'EDDB' WHEN 2 THEN 'EPWA'
              ELSE 'EDDF' END AS airport,
         direction,
         CASE WHEN direction = 'arrival' THEN 'A' ELSE 'D' END || CAST(o_orderkey AS VARCHAR)
           AS flight_number,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'CS' || CAST(o_orderkey AS VARCHAR) END
           AS callsign,
         CASE WHEN o_orderstatus = 'O' THEN ''
              WHEN o_orderpriority = '1-URGENT' THEN 'LA' ELSE 'Long Air' END AS airline,
         o_orderstatus AS origin_iata,
         'City ' || o_orderstatus AS origin_city,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN substring(o_orderpriority, 1, 1) END
           AS dest_iata,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN 'City ' || substring(o_orderpriority, 1, 1)
         END AS dest_city,
         o_orderpriority AS status,
         CASE WHEN o_orderpriority = '2-HIGH' OR o_orderstatus = 'O' THEN 'Brak'
              ELSE strftime(make_timestamp(secs * 1000000), '%H:%M') END AS scheduled_departure,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 'Brak'
              ELSE strftime(make_timestamp((secs + 5400) * 1000000), '%H:%M') END
           AS scheduled_arrival
  FROM board_sides
)"""

POSITIONS = f"""{EVENTS},
live AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'CS' || CAST(user_id AS VARCHAR) AS callsign,
         upper(substring(event_type, 1, 3)) AS airline, 'B738' AS aircraft, 'WAW' AS origin,
         event_type AS destination, CAST(user_id % 16 + 45 AS DOUBLE) AS latitude,
         CAST(k % 20 + 10 AS DOUBLE) AS longitude, k * 400 AS altitude_ft, k + 300 AS speed_kt,
         (k * 36) % 360 AS heading, k - 50 AS vertical_speed, '7000' AS squawk, ts AS timestamp
  FROM ev
)"""
