"""Delay rows with the weather of their entity's station, or of the region.

No join carries a broadcast hint. Spark broadcasts the weather side only while its
measured size is under `autoBroadcastJoinThreshold`, at planning time or by AQE once the
side is computed; beyond that it shuffles both sides, and AQE splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag import fixed
from skylag.functions import rules as rule_functions
from skylag.functions import text
from skylag.operators.checks import required_columns


def assign_station(
    delays: DataFrame,
    rules: rule_functions.Rules = fixed.STATION_RULES,
    strict_order: bool = False,
    entity: str = "ENTITY_NAME",
    output: str = "weather_station_icao",
) -> DataFrame:
    """Station code of each entity, null when no rule matches."""
    # the clean text is a column of its own, so it is computed once and not once per term
    return (
        delays.withColumn("_entity_key", text.normalise(entity))
        .withColumn(output, rule_functions.classify("_entity_key", rules, strict_order))
        .drop("_entity_key")
    )


def local_weather(station_days: DataFrame) -> DataFrame:
    return station_days.select(
        "date",
        F.col("icao").alias("weather_station_icao"),
        F.col("airport").alias("weather_station_name"),
        *fixed.STATION_DAY_MEASURES,
    )


def region_weather(region_days: DataFrame) -> DataFrame:
    return region_days.select("date", *fixed.REGION_DAY_MEASURES)


def join_station_weather(delays: DataFrame, station_days: DataFrame) -> DataFrame:
    return delays.join(local_weather(station_days), ["date", "weather_station_icao"], "left")


def join_region_weather(delays: DataFrame, region_days: DataFrame) -> DataFrame:
    return delays.join(region_weather(region_days), "date", "left")


def match_level(name_missing_weather: bool = False):
    """How precise the weather of a row is.

    `name_missing_weather` adds a fourth level for rows whose day has no weather anywhere;
    without it they carry one of the two lower levels although all features are null.
    """
    levels = F.when(
        F.col("weather_station_name").isNotNull(), F.lit(fixed.MATCH_STATION)
    )
    if name_missing_weather:
        nowhere = F.coalesce(*[F.col(c) for c in fixed.REGION_DAY_MEASURES]).isNull()
        levels = levels.when(nowhere, F.lit(fixed.MATCH_NONE))
    return levels.when(
        F.col("weather_station_icao").isNotNull(), F.lit(fixed.MATCH_STATION_WITHOUT_WEATHER)
    ).otherwise(F.lit(fixed.MATCH_REGION))


def fallback_features():
    """Station value, else region value, for each feature."""
    return {
        name: F.coalesce(local, region)
        for name, (local, region) in fixed.FALLBACK_FEATURES.items()
    }


def build_features(
    daily_delays: DataFrame,
    station_days: DataFrame,
    region_days: DataFrame,
    rules: rule_functions.Rules = fixed.STATION_RULES,
    strict_order: bool = False,
    name_missing_weather: bool = False,
) -> DataFrame:
    """Daily delays with weather columns, match level and features; one row per delay row.

    Station days must be unique per station and date (`checks.assert_unique`).
    """
    required_columns(daily_delays, "date", "ENTITY_NAME")
    required_columns(station_days, "date", "icao")
    return (
        assign_station(daily_delays, rules, strict_order)
        .transform(join_station_weather, station_days)
        .transform(join_region_weather, region_days)
        .withColumns(
            {"weather_match_level": match_level(name_missing_weather), **fallback_features()}
        )
    )


def match_quality(features: DataFrame) -> DataFrame:
    return features.groupBy("weather_match_level").count()
