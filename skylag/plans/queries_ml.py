"""Checked queries: feature choice, split, encoding, imputation, regression, metrics."""

from __future__ import annotations

from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skylag import fixed
from skylag.ml import training
from skylag.ml.table_index import TableIndexer, TableIndexerModel
from skylag.operators import ranking
from skylag.plans import sql_views as sv
from skylag.plans import views
from skylag.plans.registry import query, rounded, rounds
from skylag.session import work_path, written

FEATURE = list(fixed.FALLBACK_FEATURES)
CALENDAR_SQL = """CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
  CAST(month(date) AS INTEGER) AS month_of_year, CAST(day(date) AS INTEGER) AS day_of_month,
  CAST(dayofyear(date) AS INTEGER) AS day_of_year"""
SPLIT_SQL = f"""{sv.DAILY},
dates AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS p, count(*) OVER () AS n
          FROM (SELECT DISTINCT date FROM daily)),
cutoff AS (SELECT max(date) AS cutoff FROM dates
           WHERE p = greatest(1, CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT))),
parts AS (SELECT daily.*, CASE WHEN date < cutoff THEN 'train' ELSE 'test' END AS split
          FROM daily, cutoff)"""


@query(
    "feature_exclusion",
    f"""WITH {sv.FEATURES}
    SELECT ENTITY_NAME, ENTITY_TYPE, total_flights, weather_station_icao, weather_station_name,
           weather_match_level, {rounds(FEATURE)}, {CALENDAR_SQL} FROM features""",
)
def feature_exclusion(spark, sf):
    from skylag.functions.dates import calendar_features

    dated = views.feature_rows(spark, sf).withColumns(calendar_features())
    return rounded(dated.select(*training.feature_columns(dated.columns)), *FEATURE)


@query(
    "type_partition",
    f"""WITH {sv.FEATURES}
    SELECT name, kind, CAST(filled AS BIGINT) AS filled FROM (
      SELECT 'ENTITY_NAME' AS name, 'text' AS kind, count(ENTITY_NAME) AS filled FROM features
      UNION ALL SELECT 'ENTITY_TYPE', 'text', count(ENTITY_TYPE) FROM features
      UNION ALL SELECT 'weather_station_icao', 'text', count(weather_station_icao) FROM features
      UNION ALL SELECT 'weather_station_name', 'text', count(weather_station_name) FROM features
      UNION ALL SELECT 'weather_match_level', 'text', count(weather_match_level) FROM features
      UNION ALL SELECT 'total_flights', 'number', count(total_flights) FROM features
      {' '.join(f"UNION ALL SELECT '{c}', 'number', count({c}) FROM features" for c in FEATURE)})
    """,
)
def type_partition(spark, sf):
    """Each feature column with its kind, and how many rows have a value."""
    rows = views.feature_rows(spark, sf)
    numbers, texts = training.by_type(rows, training.feature_columns(rows.columns))
    counts = rows.agg(*[F.count(c).alias(c) for c in numbers + texts])
    return counts.unpivot([], numbers + texts, "name", "filled").select(
        "name",
        F.when(F.col("name").isin(*numbers), F.lit("number")).otherwise(F.lit("text")).alias("kind"),
        "filled",
    )


@query(
    "drop_null_label",
    f"""WITH {sv.FACTS}
    SELECT date, ENTITY_NAME, FLT_ERT_1 FROM prepared WHERE FLT_ERT_1 IS NOT NULL""",
)
def drop_null_label(spark, sf):
    return (
        views.prepared(spark, sf).select("date", "ENTITY_NAME", "FLT_ERT_1")
        .na.drop(subset=["FLT_ERT_1"])
    )


@query(
    "date_cutoff_filter",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) < DATE '1999-06-01'
              THEN 'train' ELSE 'test' END AS side FROM orders""",
)
def date_cutoff_filter(spark, sf):
    """Both sides of a fixed cutoff date, each a pushed-down filter of the scan."""
    cutoff = F.lit("1999-06-01").cast("timestamp_ntz")
    orders = views.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    train = orders.filter(F.col("o_orderdate") < cutoff).withColumn("side", F.lit("train"))
    test = orders.filter(F.col("o_orderdate") >= cutoff).withColumn("side", F.lit("test"))
    return train.unionByName(test).drop("o_orderdate")


@query("time_ordered_split", f"WITH {SPLIT_SQL} SELECT date, ENTITY_NAME, ENTITY_TYPE, split FROM parts")
def time_ordered_split(spark, sf):
    return training.label_split(written(views.daily(spark, sf), "daily")).select(
        "date", "ENTITY_NAME", "ENTITY_TYPE", "split"
    )


@query("row_counts", f"WITH {SPLIT_SQL} SELECT split, count(*) AS rows FROM parts GROUP BY split")
def row_counts(spark, sf):
    split = training.label_split(written(views.daily(spark, sf), "daily"))
    return split.groupBy("split").agg(F.count("*").alias("rows"))


# eight hexadecimal digits of a hash, as a number
_DIGITS_SQL = "CAST('0x' || substr(md5('{seed}|' || {text}), 1, 8) AS BIGINT)"
_SHARE = int(fixed.TRAIN_SHARE * 2**32)


@query(
    "random_split_fallback",
    f"""SELECT o_orderkey, CASE WHEN {_DIGITS_SQL.format(seed=fixed.SPLIT_SEED, text="CAST(o_orderkey AS VARCHAR)")}
               < {_SHARE} THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def random_split_fallback(spark, sf):
    """The side of each row in a random split."""
    orders = views.table(spark, sf, "orders").select("o_orderkey")
    side = training.random_side(orders.columns)
    return orders.select("o_orderkey", F.when(side, "train").otherwise("test").alias("split"))


@query(
    "split_few_dates",
    f"""SELECT o_orderkey, date, CASE WHEN {_DIGITS_SQL.format(
            seed=fixed.SPLIT_SEED, text="CAST(o_orderkey AS VARCHAR) || '|' || coalesce(CAST(date AS VARCHAR), '')")}
               < {_SHARE} THEN 'train' ELSE 'test' END AS split
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0
                THEN DATE '2025-01-01' + CAST(o_orderkey % 4 AS INTEGER) END AS date FROM orders)""",
)
def split_few_dates(spark, sf):
    """Three dates and rows without one: too few to split by date."""
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("o_orderkey") % 4).cast("int"))
    rows = views.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 4 > 0, day).alias("date")
    )
    return training.label_split(rows)


RANK_SQL = """SELECT label, n, row_number() OVER (ORDER BY n DESC, label) - 1
              AS label_index
FROM (SELECT {column} AS label, count(*) AS n FROM {table} GROUP BY 1)"""


@query("string_index_rank", RANK_SQL.format(column="CAST(l_suppkey AS VARCHAR)", table="lineitem"))
def string_index_rank(spark, sf):
    labels = views.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("label"))
    return ranking.label_index(labels, "label").select(
        "label", "n", F.col("label_index").cast("bigint").alias("label_index")
    )


@query(
    "string_index",
    """SELECT o_orderkey, CAST(coalesce(label_index, 4) AS DOUBLE) AS priority_index
       FROM orders LEFT JOIN (
         SELECT p, row_number() OVER (ORDER BY n DESC, p) - 1 AS label_index
         FROM (SELECT o_orderpriority AS p, count(*) AS n FROM orders
               WHERE o_orderpriority <> '5-LOW' GROUP BY 1)) ON p = o_orderpriority""",
)
def string_index(spark, sf):
    """One priority is null here: null texts get the index after the last label."""
    orders = views.table(spark, sf, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    indexer = StringIndexer(inputCol="priority", outputCol="priority_index", handleInvalid="keep")
    return indexer.fit(orders).transform(orders).select("o_orderkey", "priority_index")


@query(
    "mean_impute",
    f"""WITH {sv.FACTS}
    SELECT date, ENTITY_NAME, round(coalesce(CAST(FLT_ERT_1 AS DOUBLE),
             (SELECT avg(CAST(FLT_ERT_1 AS DOUBLE)) FROM prepared)), 6) AS flights
    FROM prepared""",
)
def mean_impute(spark, sf):
    rows = views.prepared(spark, sf).select(
        "date", "ENTITY_NAME", F.col("FLT_ERT_1").cast("double").alias("raw")
    )
    imputer = Imputer(inputCols=["raw"], outputCols=["flights"])
    return rounded(imputer.fit(rows).transform(rows).select("date", "ENTITY_NAME", "flights"))


@query(
    "assemble",
    """SELECT l_orderkey, l_linenumber, 3 AS size, l_quantity AS first, l_extendedprice AS second,
              l_discount AS third FROM lineitem""",
)
def assemble(spark, sf):
    lines = views.table(spark, sf, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    assembled = VectorAssembler(inputCols=columns, outputCol="features").transform(lines)
    vector = vector_to_array("features")
    return assembled.select(
        "l_orderkey", "l_linenumber", F.size(vector).alias("size"),
        vector[0].alias("first"), vector[1].alias("second"), vector[2].alias("third"),
    )


# Regression of the price on the quantity: both engines know the closed form of one feature.
LINE_SQL = """SELECT 1 AS model, round({slope}, 4) AS slope,
  round(avg(l_extendedprice) - {slope} * avg(l_quantity), 2) AS intercept FROM lineitem"""
OLS = "regr_slope(l_extendedprice, l_quantity)"


def _line(model):
    regression = model.stages[-1]
    return regression.coefficients[0], regression.intercept


def _price(spark, sf):
    return views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def _line_row(spark, sf, **regression):
    slope, intercept = _line(
        training.one_feature_line(_price(spark, sf), "l_quantity", "l_extendedprice", **regression)
    )
    return spark.range(1).select(
        F.lit(1).alias("model"),
        F.round(F.lit(float(slope)), 4).alias("slope"),
        F.round(F.lit(float(intercept)), 2).alias("intercept"),
    )


@query("ols_fit_legacy", LINE_SQL.format(slope=OLS))
def ols_fit_legacy(spark, sf):
    return _line_row(spark, sf, regParam=0.0, maxIter=100)


@query(
    "ridge_fit",
    LINE_SQL.format(slope=f"({OLS} / (1 + 5000.0 / stddev_pop(l_extendedprice)))"),
)
def ridge_fit(spark, sf):
    """A strong penalty, so that it shows beside prices."""
    return _line_row(spark, sf, regParam=5000.0)


# two features: correlations and the closed form of their two equations
GRAM_SQL = """WITH m AS (
  SELECT stddev_pop(l_quantity) AS s1, stddev_pop(l_discount) AS s2, stddev_pop(l_extendedprice) AS sy,
    corr(l_quantity, l_discount) AS c, corr(l_quantity, l_extendedprice) AS r1, corr(l_discount, l_extendedprice) AS r2,
    avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my FROM lineitem),
d AS (SELECT *, 1 + 500.0 / sy AS a FROM m),
b AS (SELECT *, (a * r1 - c * r2) / (a * a - c * c) * sy / s1 AS b1, (a * r2 - c * r1) / (a * a - c * c) * sy / s2 AS b2 FROM d)
SELECT l_orderkey, l_linenumber, round(my + b1 * (l_quantity - m1) + b2 * (l_discount - m2), 3) AS prediction
FROM lineitem, b"""


@query("ridge_gram_predict", GRAM_SQL)
def ridge_gram_predict(spark, sf):
    """A whole ridge fit from sums of products, and its prediction for each row."""
    rows = views.table(spark, sf, "lineitem")
    model = training.gram_ridge(rows, ["l_quantity", "l_discount"], "l_extendedprice", reg=500.0)
    return rounded(model.predict(rows).select("l_orderkey", "l_linenumber", "prediction"), digits=3)


@query(
    "string_index_table",
    """WITH ranked AS (
         SELECT c, row_number() OVER (ORDER BY n DESC, c) - 1 AS i
         FROM (SELECT CAST(o_custkey AS VARCHAR) AS c, count(*) AS n FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1))
       SELECT o_orderkey, CAST(coalesce(i, (SELECT count(*) FROM ranked)) AS DOUBLE) AS customer_index
       FROM orders LEFT JOIN ranked ON c = CAST(o_custkey AS VARCHAR)""",
)
def string_index_table(spark, sf):
    """Index of many labels, fitted on two thirds of the orders, saved, loaded and applied to all."""
    orders = views.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"))
    path = work_path(spark, "indexer")
    TableIndexer(inputCol="customer", outputCol="customer_index").fit(
        orders.filter("o_orderkey % 3 > 0")
    ).save(path)
    return TableIndexerModel.load(path).transform(orders).select("o_orderkey", "customer_index")


@query(
    "model_sink",
    f"""SELECT l_orderkey, l_linenumber, round(slope * l_quantity + intercept, 2) AS prediction
        FROM lineitem, (SELECT {OLS} AS slope,
          regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)""",
)
def model_sink(spark, sf):
    """Fit, save, load, score."""
    rows = _price(spark, sf)
    path = work_path(spark, "model")
    training.save_model(
        training.one_feature_line(rows, "l_quantity", "l_extendedprice", regParam=0.0), path
    )
    scored = training.load_model(path).transform(rows)
    return rounded(scored.select("l_orderkey", "l_linenumber", "prediction"), digits=2)


@query(
    "regression_metrics",
    """SELECT count(*) AS rows, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
              round(1 - sum(e * e) / sum((y - m) * (y - m)), 6) AS r2
       FROM (SELECT l_extendedprice AS y, l_extendedprice - 2100 * l_quantity AS e,
                    avg(l_extendedprice) OVER () AS m FROM lineitem)""",
)
def regression_metrics(spark, sf):
    """Metrics of a fixed predictor."""
    scored = _price(spark, sf).withColumn("prediction", F.col("l_quantity") * 2100)
    metrics = training.regression_metrics(scored, "l_extendedprice")
    return rounded(rounded(metrics, "rmse", "mae", digits=4), "r2")


@query("regression_train_score")
def regression_train_score(spark, sf):
    """Ridge on the feature table: earlier dates train, later dates are scored."""
    trained = training.train_and_score(views.feature_rows(spark, sf))
    return trained.predictions.select("date", "ENTITY_NAME", "prediction", fixed.LABEL)


@query(
    "pipeline_fit_transform",
    f"""WITH {SPLIT_SQL},
    known AS (SELECT * FROM parts WHERE {fixed.LABEL} IS NOT NULL),
    ranked AS (
      SELECT ENTITY_NAME, CAST(row_number() OVER (ORDER BY count(*) DESC, ENTITY_NAME) - 1 AS DOUBLE) AS x
      FROM known WHERE split = 'train' GROUP BY ENTITY_NAME),
    line AS (
      SELECT regr_slope({fixed.LABEL}, x) AS slope, regr_intercept({fixed.LABEL}, x) AS base
      FROM known JOIN ranked USING (ENTITY_NAME) WHERE split = 'train')
    SELECT date, ENTITY_NAME, ENTITY_TYPE, round(base + slope * x, 4) AS prediction
    FROM known JOIN ranked USING (ENTITY_NAME), line WHERE split = 'test'""",
)
def pipeline_fit_transform(spark, sf):
    """The older trainer as a whole: entities by frequency, split by date, unseen ones skipped, no
    penalty; a prediction for each later row."""
    rows = training.label_split(written(views.daily(spark, sf), "daily"))
    data = written(rows.filter(F.col(fixed.LABEL).isNotNull()), "legacy")
    pipeline = training.build_pipeline(
        data, ["ENTITY_NAME"], unseen="skip", regParam=0.0, solver="normal"
    )
    model = pipeline.fit(data.filter("split = 'train'"))
    scored = model.transform(data.filter("split = 'test'"))
    return rounded(scored.select("date", "ENTITY_NAME", "ENTITY_TYPE", "prediction"), digits=4)
