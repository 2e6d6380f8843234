"""Input checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag import fixed
from skylag.functions.rules import Rules


def required_columns(df: DataFrame, *names: str) -> DataFrame:
    """`df` itself, or an error that names the missing columns. Runs no job."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).count().filter("count > 1")


def assert_unique(df: DataFrame, *keys: str) -> DataFrame:
    """`df` itself, or an error when a key repeats (a join on it would multiply rows)."""
    example = duplicate_keys(df, *keys).limit(1).collect()
    if example:
        raise ValueError(f"repeated key: {example[0].asDict()}")
    return df


def rules_without_station(stations: DataFrame, rules: Rules = fixed.STATION_RULES) -> DataFrame:
    """Rule results that the station list does not hold."""
    codes = stations.sparkSession.createDataFrame([(code,) for code, _ in rules], "icao string")
    return codes.join(stations.select("icao"), "icao", "left_anti")


def undated_rows(df: DataFrame, date: str = fixed.DATE) -> DataFrame:
    """Number of rows without a date; neither side of a split by date has them."""
    return df.agg(F.count_if(F.col(date).isNull()).alias("undated"), F.count("*").alias("total"))
