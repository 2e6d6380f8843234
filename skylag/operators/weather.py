"""Hourly weather: payload rows, keyed hours, station days and region days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag import fixed, schemas
from skylag.functions import dates, keys


def _measures(spec: dict[str, tuple[str, str]]):
    return [getattr(F, how)(column).alias(name) for name, (how, column) in spec.items()]


def payload_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per time stamp of a payload of parallel arrays; other columns are kept.

    A metric array that is too short gives null, surplus values are ignored, and a payload
    without times gives no row. Text payloads are parsed first.
    """
    kept = [c for c in payloads.columns if c != payload]
    parsed = F.col(payload)
    if dict(payloads.dtypes)[payload] == "string":
        parsed = F.from_json(parsed, schemas.HOURLY_PAYLOAD)
    # Rows are put together inside the payload and unfolded last: unfolding the times alone
    # would carry all arrays along with every single row.
    rows = F.transform(
        "_hourly.time",
        lambda time, i: F.struct(
            time.alias("time"),
            *[F.get(f"_hourly.{m}", i).alias(m) for m in fixed.HOURLY_METRICS],
        ),
    )
    return (
        payloads.select(*kept, parsed["hourly"].alias("_hourly"))
        .select(*kept, F.explode(rows).alias("_row"))
        .select(*kept, "_row.*")
    )


def payload_hourly(payloads: DataFrame, stations: DataFrame, payload: str = "payload") -> DataFrame:
    """Hourly weather of payloads that name their station in `icao`, as the weather tables take it.

    Times are UTC. Name and place come from the stations, one row each; a station that is not among
    them has null there. A time that does not parse is an error. Other columns are kept.
    """
    rows = payload_rows(payloads, payload).withColumn(
        "time", F.to_timestamp("time", "yyyy-MM-dd'T'HH:mm")
    )
    named = stations.select(*schemas.STATIONS.fieldNames())
    kept = [c for c in payloads.columns if c not in (payload, "icao")]
    return rows.join(named, "icao", "left").select(*kept, *schemas.HOURLY_WEATHER.fieldNames())


def hourly_keyed(hourly: DataFrame) -> DataFrame:
    """Hourly rows with date, hour and the text key for a later join to a stream."""
    return hourly.withColumns({"date": dates.to_day("time"), "hour": F.hour("time")}).withColumn(
        "weather_join_key", keys.hour_key("icao", "date", "hour")
    )


def station_day(hourly: DataFrame) -> DataFrame:
    """Thirteen aggregates per station and day."""
    return (
        hourly.withColumn("date", dates.to_day("time"))
        .groupBy("icao", "airport", "date")
        .agg(*_measures(fixed.STATION_DAY_MEASURES))
    )


def region_day(station_days: DataFrame) -> DataFrame:
    """Per day, the plain mean of the stations' values, however many hours each one has."""
    return station_days.groupBy("date").agg(*_measures(fixed.REGION_DAY_MEASURES))


def station_hour(hourly: DataFrame) -> DataFrame:
    """Mean weather per station, date and hour: the side a stream joins to, one row per key."""
    return (
        hourly.groupBy(
            F.col("icao").alias("station"),
            dates.to_day("time").alias("date"),
            F.hour("time").alias("hour"),
        ).agg(
            F.avg("temperature_2m").alias("hour_temperature"),
            F.sum("precipitation").alias("hour_precipitation"),
            F.max("wind_gusts_10m").alias("hour_wind_gusts"),
        )
    )


def sort_station_days(df: DataFrame) -> DataFrame:
    return df.orderBy("icao", "date", "airport")


def sort_region_days(df: DataFrame) -> DataFrame:
    return df.orderBy("date")
