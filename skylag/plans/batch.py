"""The batch jobs from raw files to a scored model. Each one reads and writes tables.

    spark-submit --py-files skylag.zip bin/batch.py all --flights 'raw/flights/*.csv.bz2' \
        --weather raw/weather.csv --out warehouse
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import fixed, schemas
from skylag.ml import training
from skylag.operators import checks, delays, features, weather
from skylag.session import build_session
from skylag.sources import files, stations, tables

DAILY, MONTHLY, ENTITY = "daily_delays", "monthly_delays", "entity_delays"
HOURLY, STATION_DAY, REGION_DAY = (
    "weather_hourly_features", "weather_daily", "weather_europe_daily",
)
STATION_HOUR = "station_hours"
FEATURES, MODEL = "daily_features", "delay_regression"
# partition column of the dated tables; readers get the tables without it
YEAR = "table_year"


def read_table(
    spark: SparkSession, out: str, name: str, first: date | None = None, last: date | None = None,
    years: list[int] | None = None,
) -> DataFrame:
    """A table of the batch job. With dates, only the years between them are opened; or only `years`."""
    rows = tables.read_table(spark, f"{out.rstrip('/')}/{name}")
    if first is not None:
        rows = rows.filter((F.col(YEAR) >= first.year) & (F.col(fixed.DATE) >= F.lit(first)))
    if last is not None:
        rows = rows.filter((F.col(YEAR) <= last.year) & (F.col(fixed.DATE) <= F.lit(last)))
    if years is not None:
        rows = rows.filter(F.col(YEAR).isin(years)) if years else rows.limit(0)
    return rows.drop(YEAR)


def _save(df: DataFrame, out: str, name: str, by_year: bool = False) -> DataFrame:
    """Replace a table, or of a dated one the days from the first to the last of `df`, and open it."""
    path = f"{out.rstrip('/')}/{name}"
    if by_year:
        tables.replace_table(df.withColumn(YEAR, F.year(fixed.DATE)), path, (YEAR,), within=fixed.DATE)
    else:
        tables.replace_table(df, path)
    return read_table(df.sparkSession, out, name)


def delay_tables(facts: DataFrame, out: str) -> dict[str, DataFrame]:
    """Day, month and entity delays. The facts are read once: the other two come from the days."""
    daily = _save(delays.daily(delays.prepare_facts(facts)), out, DAILY, by_year=True)
    return {
        DAILY: daily,
        MONTHLY: _save(delays.monthly_from_daily(daily), out, MONTHLY),
        ENTITY: _save(delays.by_entity_from_daily(daily), out, ENTITY),
    }


def weather_tables(hourly: DataFrame, out: str) -> dict[str, DataFrame]:
    """Keyed hours, station days and region days. Raw text is parsed once."""
    keyed = _save(weather.hourly_keyed(hourly), out, HOURLY)
    station_days = _save(weather.station_day(keyed), out, STATION_DAY, by_year=True)
    return {
        HOURLY: keyed,
        STATION_DAY: station_days,
        REGION_DAY: _save(weather.region_day(station_days), out, REGION_DAY),
        STATION_HOUR: _save(weather.station_hour(keyed), out, STATION_HOUR, by_year=True),
    }


def payload_weather(spark: SparkSession, path: str, station_path: str) -> DataFrame:
    """Hourly weather from files of JSON payloads, one a line, each with its station in `icao`."""
    schema = T.StructType([T.StructField("icao", T.StringType()), *schemas.HOURLY_PAYLOAD.fields])
    payloads = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return weather.payload_hourly(
        payloads.select("icao", F.struct("hourly").alias("payload")),
        checks.assert_unique(stations.load_stations(spark, station_path), "icao"),
    )


def feature_table(spark: SparkSession, out: str, rules=fixed.STATION_RULES, **options):
    station_days = checks.assert_unique(read_table(spark, out, STATION_DAY), "icao", "date")
    built = features.build_features(
        read_table(spark, out, DAILY), station_days, read_table(spark, out, REGION_DAY), rules, **options
    )
    return _save(built, out, FEATURES, by_year=True)


def model(spark: SparkSession, out: str, **options) -> training.Trained:
    trained = training.train_and_score(read_table(spark, out, FEATURES), **options)
    training.save_model(trained.model, f"{out.rstrip('/')}/{MODEL}")
    return trained


BAD_LINE = "bad_line"


def good_rows(rows: DataFrame, out: str, name: str) -> DataFrame:
    """The rows without their bad lines, which become a table of their own and are counted."""
    if BAD_LINE not in rows.columns:
        return rows
    bad = _save(rows.filter(F.isnotnull(BAD_LINE)).select(BAD_LINE), out, f"{name}_{BAD_LINE}s")
    print(f"{name}: {bad.count()} bad lines left out")
    return rows.filter(F.isnull(BAD_LINE)).drop(BAD_LINE)


def run(
    spark: SparkSession, step: str, flights: list[str], weather_path: str, out: str,
    keep_bad_lines: bool = False, payloads: str = "", station_path: str = "",
) -> None:
    options = {"bad_lines": BAD_LINE} if keep_bad_lines else {}
    if step in ("all", "delays"):
        facts = files.scan_yearly(spark, flights, schemas.DELAY_FACTS, **options)
        delay_tables(good_rows(facts, out, "flights"), out)
    if step in ("all", "weather"):
        if payloads:
            weather_tables(payload_weather(spark, payloads, station_path), out)
        else:
            hours = files.scan_csv(spark, weather_path, schemas.HOURLY_WEATHER, **options)
            weather_tables(good_rows(hours, out, "weather"), out)
    if step in ("all", "features"):
        built = feature_table(spark, out)
        features.match_quality(built).show(truncate=False)
    if step in ("all", "train"):
        trained = model(spark, out)
        print(f"train rows {trained.train_rows}, test rows {trained.test_rows}")
        print(", ".join(f"{name} {value:.4f}" for name, value in trained.metrics.items()))


def main() -> None:
    parser = argparse.ArgumentParser(description="Delay and weather batch jobs")
    parser.add_argument("step", choices=["all", "delays", "weather", "features", "train"])
    parser.add_argument("--flights", nargs="*", default=[], help="yearly CSV files or patterns")
    parser.add_argument("--weather", default="", help="hourly weather CSV")
    parser.add_argument("--out", required=True, help="folder of the result tables")
    parser.add_argument(
        "--keep-bad-lines", action="store_true",
        help="put lines that do not parse into tables of their own instead of failing",
    )
    parser.add_argument("--payloads", default="", help="JSON payloads instead of the weather CSV")
    parser.add_argument("--stations", default="", help="station list for the payloads")
    args = parser.parse_args()
    run(
        build_session("skylag-batch"), args.step, args.flights, args.weather, args.out,
        args.keep_bad_lines, args.payloads, args.stations,
    )


if __name__ == "__main__":
    main()
