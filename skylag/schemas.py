"""Declared schemas. Nothing is inferred, so no file is read twice."""

from __future__ import annotations

from pyspark.sql import types as T

from skylag import fixed


def _fields(kind, names):
    return [T.StructField(name, kind, True) for name in names]


DELAY_FACTS = T.StructType(
    [T.StructField("FLT_DATE", T.TimestampType())]
    + _fields(T.StringType(), ["ENTITY_NAME", "ENTITY_TYPE"])
    + _fields(T.LongType(), [fixed.FLIGHTS])
    + _fields(T.DoubleType(), [fixed.TOTAL_DELAY])
    + _fields(T.DoubleType(), [f"DLY_ERT_{code}_1" for code in fixed.CAUSE_CODES])
    + _fields(T.LongType(), [fixed.DELAYED_FLIGHTS, fixed.DELAYED_FLIGHTS_15])
)

STATIONS = T.StructType(
    _fields(T.StringType(), ["icao", "airport"])
    + _fields(T.DoubleType(), ["latitude", "longitude"])
)

HOURLY_WEATHER = T.StructType(
    STATIONS.fields
    + _fields(T.TimestampType(), ["time"])
    + _fields(T.DoubleType(), fixed.HOURLY_METRICS)
)

# One payload: parallel arrays, one per metric, that may differ in length.
HOURLY_PAYLOAD = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                _fields(T.ArrayType(T.StringType()), ["time"])
                + _fields(T.ArrayType(T.DoubleType()), fixed.HOURLY_METRICS)
            ),
        )
    ]
)

METAR_RAW = T.StructType(
    _fields(T.StringType(), ["station_id", "observation_time", *fixed.METAR_FIELDS])
)

# METAR event as decoded from a topic: texts, plus the untouched record as a map.
METAR_EVENT = T.StructType(
    _fields(
        T.StringType(),
        [
            "source", "data_source", "ingested_at", "station_id", "observation_time",
            "observation_date", "observation_hour", *fixed.METAR_FIELDS,
        ],
    )
    + [T.StructField("full_record", T.MapType(T.StringType(), T.StringType()))]
    + _fields(T.StringType(), ["feature_join_key"])
)

# All feed fields are text: the feed mixes numbers and words in one field.
FEED_RECORD = T.StructType(
    _fields(
        T.StringType(),
        [
            "flight_iata", "flight_icao", "flight_number", "dep_iata", "departure_iata",
            "dep", "arr_iata", "arrival_iata", "arr", "delay", "dep_delay",
            "arrival_delay", "delay_minutes", "_source", "_fetched_at",
            "_airlabs_delay_threshold", "_airlabs_type",
        ],
    )
)

EVENT_LOG = T.StructType(_fields(T.StringType(), fixed.EVENT_LOG_FIELDS))

POSITIONS = T.StructType(
    _fields(
        T.StringType(),
        [
            "id", "callsign", "airline_icao", "aircraft_code", "origin_airport_iata",
            "destination_airport_iata", "squawk",
        ],
    )
    + _fields(T.DoubleType(), ["latitude", "longitude"])
    + _fields(T.IntegerType(), ["altitude", "ground_speed", "heading", "vertical_speed"])
)

BOARD_ROW = T.StructType(
    _fields(
        T.StringType(),
        [
            "flight_number", "callsign", "airline", "origin_iata", "origin_city",
            "dest_iata", "dest_city", "status", "scheduled_departure",
            "scheduled_arrival",
        ],
    )
)

_END = "code: struct<iata: string>, position: struct<region: struct<city: string>>"
_FLIGHT = (
    "struct<flight: struct<"
    "identification: struct<number: struct<default: string>, callsign: string>, "
    "airline: struct<name: string, short: string>, "
    f"airport: struct<origin: struct<{_END}>, destination: struct<{_END}>>, "
    "status: struct<text: string>, "
    "time: struct<scheduled: struct<departure: bigint, arrival: bigint>>>>"
)
BOARD = (
    "result struct<response: struct<airport: struct<pluginData: struct<schedule: struct<"
    f"arrivals: struct<data: array<{_FLIGHT}>>, "
    f"departures: struct<data: array<{_FLIGHT}>>>>>>>"
)
