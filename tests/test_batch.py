from datetime import datetime, timedelta

from pyspark.sql import functions as F

from skylag import fixed
from skylag.ml import training
from skylag.plans import batch
from skylag.sources import files

ENTITIES = ["DFS", "PANSA", "Unknown ANSP"]


def raw_files(spark, path):
    first = datetime(2025, 12, 1)
    facts = spark.range(60 * len(ENTITIES)).select(
        F.timestamp_add("DAY", (F.col("id") / len(ENTITIES)).cast("int"), F.lit(first)).alias("FLT_DATE"),
        F.array(*map(F.lit, ENTITIES))[(F.col("id") % len(ENTITIES)).cast("int")].alias("ENTITY_NAME"),
        F.lit("ANSP").alias("ENTITY_TYPE"),
        (F.col("id") % 5).alias(fixed.FLIGHTS),
        (F.col("id") * 3).alias(fixed.TOTAL_DELAY),
        *[F.when(F.col("id") % 2 == 0, F.col("id") % 4).alias(f"DLY_ERT_{c}_1") for c in fixed.CAUSE_CODES],
        F.col("id").alias(fixed.DELAYED_FLIGHTS),
        F.lit(1).alias(fixed.DELAYED_FLIGHTS_15),
    )
    year = F.year("FLT_DATE")
    files.write_csv(facts.filter(year == 2025), f"{path}/f2025", compression="bzip2")
    files.write_csv(facts.filter(year == 2026).select(*reversed(facts.columns)), f"{path}/f2026", compression="bzip2")
    weather = [
        f"{icao},{name},50.0,10.0,{first + timedelta(hours=h):%Y-%m-%dT%H:%M},{h % 20},,1,0.5,0.1,,50,1000,990,10,{h % 30}"
        for icao, name in (("EDDF", "Frankfurt"), ("LFPG", "Paris")) for h in range(40 * 24)
    ]
    header = ",".join(["icao", "airport", "latitude", "longitude", "time", *fixed.HOURLY_METRICS])
    with open(f"{path}/weather.csv", "w") as handle:
        handle.write("\n".join([header, *weather]) + "\n")
    return [f"{path}/f2025", f"{path}/f2026"], f"{path}/weather.csv"


def test_all_steps(spark, path, capsys):
    flights, weather = raw_files(spark, path)
    batch.run(spark, "all", flights, weather, f"{path}/out")
    printed = capsys.readouterr().out
    assert "rmse" in printed and "test rows" in printed
    rows = {n: batch.read_table(spark, f"{path}/out", n).count()
            for n in (batch.DAILY, batch.MONTHLY, batch.ENTITY, batch.HOURLY, batch.STATION_DAY, batch.REGION_DAY)}
    assert rows == {batch.DAILY: 180, batch.MONTHLY: 2, batch.ENTITY: 3, batch.HOURLY: 1920,
                    batch.STATION_DAY: 80, batch.REGION_DAY: 40}
    built = batch.read_table(spark, f"{path}/out", batch.FEATURES)
    levels = {r[0]: r[1] for r in built.groupBy("weather_match_level").count().collect()}
    assert levels == {"entity_station": 40, "station_missing_weather": 80, "europe_fallback": 60}
    model = training.load_model(f"{path}/out/{batch.MODEL}")
    scored = model.transform(training.training_frame(built))
    assert scored.filter("prediction IS NULL").count() == 0


def test_dated_tables_are_read_by_year(spark, path):
    from datetime import date

    rows = spark.range(800).select(F.date_add(F.lit(date(2024, 6, 1)), F.col("id").cast("int")).alias("date"), "id")
    batch._save(rows, path, "t", by_year=True)
    later = rows.filter("year(date) = 2025").withColumn("id", -F.col("id"))
    assert batch._save(later, path, "t", by_year=True).count() == 800
    part = batch.read_table(spark, path, "t", date(2025, 3, 1), date(2025, 3, 31))
    assert part.count() == 31 and part.filter("id > 0").count() == 0 and part.columns == ["date", "id"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_year" in plan


def test_bad_lines_become_a_table(spark, path, capsys):
    flights, _ = raw_files(spark, path)
    with open(f"{path}/more.csv", "w") as handle:
        handle.write("FLT_DATE,ENTITY_NAME,ENTITY_TYPE,FLT_ERT_1,DLY_ERT_1\n2026-03-01T00:00:00,DFS,ANSP,2,x7\n"
                     "2026-03-02T00:00:00,DFS,ANSP,2,7\n")
    batch.run(spark, "delays", [*flights, f"{path}/more.csv"], "", f"{path}/out", keep_bad_lines=True)
    assert "flights: 1 bad lines left out" in capsys.readouterr().out
    assert batch.read_table(spark, f"{path}/out", batch.DAILY).count() == 181
    assert "x7" in batch.read_table(spark, f"{path}/out", "flights_bad_lines").first().bad_line


def test_weather_from_payloads(spark, path):
    import json

    with open(f"{path}/p.json", "w") as handle:
        for icao in ("EPWA", "EDDF"):
            times = [f"2025-03-0{d}T{h:02}:00" for d in (1, 2) for h in range(24)]
            handle.write(json.dumps({"icao": icao, "hourly": {"time": times, "temperature_2m": [1.0] * 30}}) + "\n")
    with open(f"{path}/s.csv", "w") as handle:
        handle.write("icao,airport,latitude,longitude\nEPWA,Warsaw,52.1,20.9\nEDDF,Frankfurt,50.0,8.5\n")
    batch.run(spark, "weather", [], "", f"{path}/out", payloads=f"{path}/p.json", station_path=f"{path}/s.csv")
    days = batch.read_table(spark, f"{path}/out", batch.STATION_DAY)
    assert sorted((r.icao, r.airport, str(r.date)) for r in days.collect()) == [
        ("EDDF", "Frankfurt", "2025-03-01"), ("EDDF", "Frankfurt", "2025-03-02"),
        ("EPWA", "Warsaw", "2025-03-01"), ("EPWA", "Warsaw", "2025-03-02"),
    ]
    assert batch.read_table(spark, f"{path}/out", batch.STATION_HOUR).count() == 96
