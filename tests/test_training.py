from datetime import date, timedelta

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from skylag import fixed
from skylag.ml import training
from skylag.operators import ranking
from skylag.plans import views

SF = "/root/testdata/sf0.001"


def rows_on(spark, n_dates, per_date=3):
    first = date(2025, 1, 1)
    return spark.createDataFrame(
        [(first + timedelta(days=d), float(d + i), f"E{i}") for d in range(n_dates) for i in range(per_date)],
        "date date, delay_per_flight double, ENTITY_NAME string",
    )


@pytest.mark.parametrize("n_dates, train_dates", [(5, 4), (6, 4), (10, 8), (11, 8)])
def test_split_by_date(spark, n_dates, train_dates):
    data = rows_on(spark, n_dates)
    train, test = training.split_by_date(data)
    assert train.select("date").distinct().count() == train_dates
    assert test.count() == 3 * (n_dates - train_dates)
    assert train.agg(F.max("date")).first()[0] < test.agg(F.min("date")).first()[0]
    flagged = training.label_split(data).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in flagged} == {"train": train.count(), "test": test.count()}


def test_few_dates_are_split_at_random(spark):
    data = rows_on(spark, 4, per_date=100)
    train, test = training.split_by_date(data)
    assert train.count() + test.count() == 400 and 250 < train.count() < 390
    assert train.select("date").distinct().count() == 4
    again, _ = training.split_by_date(data.repartition(7))
    assert sorted(again.collect()) == sorted(train.collect())


def test_split_ignores_rows_without_a_date(spark):
    data = rows_on(spark, 5).union(spark.createDataFrame([(None, 1.0, "E")], "d date, l double, e string"))
    train, test = training.split_by_date(data)
    assert train.count() + test.count() == 15


def test_undated_rows_are_counted(spark):
    from skylag.operators.checks import undated_rows

    data = spark.createDataFrame([(None,), (date(2025, 1, 1),)], "date date")
    assert tuple(undated_rows(data).first()) == (1, 2)


def test_split_needs_dates(spark):
    """Days are few; time stamps need not be, and the ordered list of them runs in one task."""
    with pytest.raises(TypeError):
        training.date_cutoff(spark.sql("SELECT current_timestamp() AS date"))


def test_feature_choice(spark):
    rows = views.feature_rows(spark, SF)
    columns = training.feature_columns(rows.columns)
    assert len(training.EXCLUDED) == 29 and fixed.LABEL not in columns
    numbers, texts = training.by_type(rows, columns)
    assert numbers == ["total_flights", *fixed.FALLBACK_FEATURES]
    assert set(texts) == {
        "ENTITY_NAME", "ENTITY_TYPE", "weather_station_icao", "weather_station_name", "weather_match_level",
    }


def test_training_frame(spark):
    data = rows_on(spark, 2).withColumn("total_delay", F.lit(1.0)).withColumn("flights", F.lit(3))
    data = data.withColumn("delay_per_flight", F.when(F.col("ENTITY_NAME") != "E0", F.col("delay_per_flight")))
    frame = training.training_frame(data)
    assert frame.count() == 4 and "total_delay" not in frame.columns
    assert dict(frame.dtypes)["flights"] == "double"
    with pytest.raises(ValueError, match="missing columns"):
        training.training_frame(data.drop("date"))


def test_pipeline_handles_unseen_texts_nulls_and_empty_columns(spark):
    data = rows_on(spark, 6).withColumns(
        {
            "ENTITY_NAME": F.when(F.col("date") >= "2025-01-06", F.lit("new")).otherwise(F.col("ENTITY_NAME")),
            "nothing": F.lit(None).cast("double"),
            "flights": F.when(F.col("ENTITY_NAME") != "E1", F.dayofmonth("date")),
        }
    )
    for encode in ("ordinal", "onehot"):
        trained = training.train_and_score(data, encode=encode)
        assert "nothing" not in trained.columns and "flights" in trained.columns
        assert trained.train_rows == 12 and trained.test_rows == 6
        assert trained.predictions.filter("prediction IS NULL").count() == 0
        assert trained.metrics["rmse"] >= 0
    skipped = training.build_pipeline(data, ["ENTITY_NAME"], unseen="skip").fit(data.filter("date < '2025-01-06'"))
    assert skipped.transform(data).count() == 15


def test_imputed_mean_is_not_cut(spark):
    data = spark.createDataFrame(
        [(date(2025, 1, 1), 1.0, 2), (date(2025, 1, 2), 2.0, 3), (date(2025, 1, 3), 3.0, None)],
        "date date, delay_per_flight double, flights int",
    )
    frame = training.training_frame(data)
    model = training.build_pipeline(frame, ["flights"]).fit(frame)
    assert [r[0] for r in model.transform(frame).orderBy("date").select("flights_imputed").collect()] == [2.0, 3.0, 2.5]


def test_metrics_equal_the_evaluator(spark):
    scored = spark.createDataFrame([(float(i), float(i * i % 7)) for i in range(50)], "y double, prediction double")
    row = training.regression_metrics(scored, "y").first()
    for name in ("rmse", "r2", "mae"):
        expected = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName=name).evaluate(scored)
        assert row[name] == pytest.approx(expected, rel=1e-9)


def test_ridge_closed_form_and_reload(spark, path):
    data = spark.createDataFrame([(float(i), 3.0 * i + (i * 7 % 5)) for i in range(40)], "x double, y double")
    stats = data.select(F.regr_slope("y", "x"), F.stddev_pop("y")).first()
    for reg in (0.0, 0.1, 5.0):
        model = training.one_feature_line(data, "x", "y", regParam=reg)
        assert model.stages[-1].coefficients[0] == pytest.approx(training.ridge_slope(*stats, reg), rel=1e-9)
    training.save_model(model, f"{path}/m")
    training.save_model(model, f"{path}/m")
    again = training.load_model(f"{path}/m")
    assert again.transform(data).select("prediction").collect() == model.transform(data).select("prediction").collect()


def test_global_rank_numbers_all_rows_once(spark):
    data = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5003).alias("v"))
    ranked = ranking.global_rank(data, [F.desc("v")]).collect()
    ordered = sorted(ranked, key=lambda r: -r.v)
    assert [r["rank"] for r in ordered] == list(range(5000))


def test_label_index_equals_the_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    data = spark.createDataFrame([(t,) for t in "bbbaaaccd"] + [(None,)], "t string")
    labels = StringIndexer(inputCol="t", outputCol="i").setHandleInvalid("keep").fit(data).labels
    ranked = {r.t: r.label_index for r in ranking.label_index(data, "t").collect()}
    assert ranked == {t: i for i, t in enumerate(labels)}


def test_record_limit(spark):
    data = spark.range(10)
    assert ranking.limit_records(data, 0, "id").count() == 10
    assert [r.id for r in ranking.limit_records(data, 3, F.desc("id")).collect()] == [9, 8, 7]
