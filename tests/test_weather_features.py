from datetime import date, datetime

import pytest

from skylag import fixed, schemas
from skylag.operators import checks, features, feeds, weather
from skylag.plans import views
from skylag.sources.stations import load_stations

SF = "/root/testdata/sf0.001"


def hour(icao, day, h, temperature, airport="X", rain=None, gust=None):
    row = {f.name: None for f in schemas.HOURLY_WEATHER.fields}
    row.update(icao=icao, airport=airport, time=datetime(2025, 3, day, h), temperature_2m=temperature,
               rain=rain, wind_gusts_10m=gust)
    return row


@pytest.fixture(scope="module")
def hourly(spark):
    return spark.createDataFrame(
        [
            hour("EPWA", 30, 2, 1.0, rain=1.0, gust=10.0), hour("EPWA", 30, 3, 3.0, gust=30.0),
            hour("EDDF", 30, 2, 10.0, rain=5.0), hour("EPWA", 31, 0, None),
        ],
        schemas.HOURLY_WEATHER,
    )


def test_hours_are_utc(hourly):
    """In a local zone with a clock change these two hours would share a key."""
    keys = {r[0] for r in weather.hourly_keyed(hourly).select("weather_join_key").collect()}
    assert {"EPWA|2025-03-30|02", "EPWA|2025-03-30|03"} <= keys


def test_station_and_region_days(hourly):
    days = weather.station_day(hourly)
    by_key = {(r.icao, r.date.day): r for r in days.collect()}
    warsaw = by_key[("EPWA", 30)]
    assert (warsaw.avg_temperature, warsaw.min_temperature, warsaw.max_temperature) == (2.0, 1.0, 3.0)
    assert (warsaw.total_rain, warsaw.max_wind_gusts, warsaw.avg_humidity) == (1.0, 30.0, None)
    assert len(days.columns) == 16
    region = {r.date.day: r for r in weather.region_day(days).collect()}
    # plain mean of the two stations although one has twice the hours
    assert region[30].avg_temperature_europe == 6.0 and region[30].avg_rain_europe == 3.0
    assert region[31].avg_temperature_europe is None


def test_payload_rows(spark):
    texts = [
        '{"hourly": {"time": ["t0", "t1"], "rain": [1.5], "snowfall": [1, 2, 3]}}',
        '{"hourly": {"time": [], "rain": [1.0]}}', '{"hourly": null}', '{}', 'bad',
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    rows = weather.payload_rows(df).select("id", "time", "rain", "snowfall", "cloud_cover").collect()
    assert [tuple(r) for r in rows] == [(0, "t0", 1.5, 1.0, None), (0, "t1", None, 2.0, None)]


def test_station_with_two_names_is_refused(spark, hourly):
    twice = hourly.unionByName(
        spark.createDataFrame([hour("EPWA", 30, 5, 9.0, airport="Y")], schemas.HOURLY_WEATHER)
    )
    days = weather.station_day(twice)
    with pytest.raises(ValueError, match="repeated key"):
        checks.assert_unique(days, "icao", "date")
    assert checks.assert_unique(weather.station_day(hourly), "icao", "date") is not None


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="date, x"):
        checks.required_columns(spark.range(1), "id", "date", "x")


def test_rules_without_station(spark):
    stations = load_stations(spark)
    assert checks.rules_without_station(stations).count() == 0
    fewer = stations.filter("icao != 'UKBB'")
    assert [r[0] for r in checks.rules_without_station(fewer).collect()] == ["UKBB"]


@pytest.fixture(scope="module")
def built(spark, hourly):
    daily = spark.createDataFrame(
        [
            (date(2025, 3, 30), "PANSA (Poland)", 1.0), (date(2025, 3, 30), " Ukraine ", 2.0),
            (date(2025, 3, 30), "Nobody", 3.0), (date(2025, 3, 31), "DFS", 4.0),
            (date(2025, 4, 1), "DFS", 5.0), (None, "DFS", 6.0),
        ],
        "date date, ENTITY_NAME string, total_delay double",
    )
    days = weather.station_day(hourly)

    def build(**options):
        rows = features.build_features(daily, days, weather.region_day(days), **options).collect()
        return {r.total_delay: r for r in rows}

    return build


def test_match_levels_and_fallback(built):
    rows = built()
    assert len(rows) == 6
    assert rows[1.0].weather_match_level == "entity_station" and rows[1.0].feature_temperature == 2.0
    assert rows[2.0].weather_station_icao == "UKBB"
    assert rows[2.0].weather_match_level == "station_missing_weather"
    assert rows[2.0].feature_temperature == 6.0
    assert rows[3.0].weather_match_level == "europe_fallback" and rows[3.0].feature_rain == 3.0
    assert rows[5.0].weather_match_level == "station_missing_weather"
    assert rows[5.0].feature_temperature is None


def test_named_missing_weather_and_strict_order(built):
    rows = built(name_missing_weather=True, strict_order=True)
    assert rows[5.0].weather_match_level == "no_weather"
    assert rows[6.0].weather_match_level == "no_weather"
    assert rows[2.0].weather_station_icao == "EGLL"
    assert rows[1.0].weather_match_level == "entity_station"


def test_feature_rows_keep_every_delay_row(spark):
    built = views.feature_rows(spark, SF)
    assert built.count() == views.daily(spark, SF).count()
    levels = {r[0] for r in features.match_quality(built).collect()}
    assert levels == {fixed.MATCH_STATION, fixed.MATCH_STATION_WITHOUT_WEATHER, fixed.MATCH_REGION}


def test_entity_text_is_cleaned_once_per_row(spark):
    daily = views.daily(spark, SF)
    plan = features.assign_station(daily)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 1


def test_no_join_forces_a_broadcast(spark):
    """Beyond the size limit the weather sides are shuffled, not broadcast."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    spark.conf.set(adaptive, "-1")
    try:
        df = views.feature_rows(spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert df.count() == views.daily(spark, SF).count()
    finally:
        spark.conf.set(limit, before)
        spark.conf.unset(adaptive)


def test_positions_on_the_border(spark):
    points = [(49.0, 14.0), (55.0, 24.0), (48.9, 20.0), (50.0, 24.1), (52.0, 20.0)]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    assert sorted(tuple(r) for r in feeds.in_box(df).collect()) == [(49.0, 14.0), (52.0, 20.0), (55.0, 24.0)]
