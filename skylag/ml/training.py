"""Feature choice, split by date, pipeline, metrics, saving."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylag import fixed
from skylag.functions.dates import calendar_features
from skylag.operators.checks import required_columns
from skylag.session import written

EXCLUDED = (
    fixed.DATE,
    *fixed.LEAKING_COLUMNS,
    *fixed.STATION_DAY_MEASURES,
    *fixed.REGION_DAY_MEASURES,
)


# --- columns -------------------------------------------------------------------------


def feature_columns(columns: list[str], label: str = fixed.LABEL) -> list[str]:
    """All columns but the label, the date, and those that leak the label or are raw weather."""
    return [c for c in columns if c not in EXCLUDED and c != label]


def by_type(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """(number columns, other columns), each in the order given."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [c for c in columns if c in numeric], [c for c in columns if c not in numeric]


def training_frame(features: DataFrame, label: str = fixed.LABEL) -> DataFrame:
    """Date, label and features with calendar columns; rows without a label are dropped.

    Numbers become doubles: an imputed mean would be cut to a whole number in a whole-number
    column.
    """
    required_columns(features, label, fixed.DATE)
    dated = features.withColumns(calendar_features())
    columns = feature_columns(dated.columns, label)
    if not columns:
        raise ValueError("no feature columns")
    numeric, _ = by_type(dated, columns)
    return dated.select(
        fixed.DATE,
        F.col(label).cast("double").alias(label),
        *[F.col(c).cast("double").alias(c) if c in numeric else F.col(c) for c in columns],
    ).na.drop(subset=[label])


# --- split ---------------------------------------------------------------------------


def date_cutoff(df: DataFrame, share: float = fixed.TRAIN_SHARE) -> DataFrame:
    """One row: number of distinct dates, and the date at position floor(share * n), which is kept
    within 1 and n - 1, so that both sides have a date where there are two.

    Dates are made distinct in parallel first; the window runs over one row per calendar day.
    """
    if not isinstance(df.schema[fixed.DATE].dataType, T.DateType):
        raise TypeError(f"{fixed.DATE} must be a date")
    days = df.select(fixed.DATE).filter(F.col(fixed.DATE).isNotNull()).distinct()
    numbered = days.select(
        fixed.DATE,
        (F.row_number().over(Window.orderBy(fixed.DATE)) - 1).alias("position"),
        F.count("*").over(Window.partitionBy()).alias("n_dates"),
    )
    if not 0 < share < 1:
        raise ValueError("the share of the first side must lie between 0 and 1")
    at = F.greatest(F.lit(1), F.least(F.floor(F.col("n_dates") * F.lit(share)), F.col("n_dates") - 1))
    return numbered.agg(
        F.max("n_dates").alias("n_dates"),
        F.max(F.when(F.col("position") == at, F.col(fixed.DATE))).alias("cutoff"),
    )


SPLIT_MARK = "|"


def random_side(
    columns: list[str], share: float = fixed.TRAIN_SHARE, seed: int = fixed.SPLIT_SEED
) -> Column:
    """True for the rows of the first side of a random split.

    The first digits of a hash of the row's texts decide, so a partition that is computed again
    falls on the same side, and other tools can repeat it. Nulls count as empty texts.
    """
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digits = F.substring(F.md5(F.concat_ws(SPLIT_MARK, F.lit(str(seed)), *cells)), 1, 8)
    return F.conv(digits, 16, 10).cast("long") < int(share * 2**32)


def random_split(df: DataFrame, share: float = fixed.TRAIN_SHARE, seed: int = fixed.SPLIT_SEED):
    side = random_side(df.columns, share, seed)
    return df.filter(side), df.filter(~side)


def _sides(train: Column, by_chance: Column, days) -> Column:
    """The side of each row, given one row of `date_cutoff` as columns."""
    n_dates, cutoff = days
    few = F.coalesce(n_dates, F.lit(0)) < fixed.MIN_SPLIT_DATES
    by_date = F.when(train < cutoff, "train").when(train >= cutoff, "test")
    return F.when(few, F.when(by_chance, "train").otherwise("test")).otherwise(by_date)


def label_split(df: DataFrame, share: float = fixed.TRAIN_SHARE) -> DataFrame:
    """The rows with a `split` column, in a single plan.

    Dates before the cutoff are `train`, the rest `test`; rows without a date are left out. Under
    five distinct dates the split is random, and rows without a date take part.
    """
    days = date_cutoff(df, share)
    found = tuple(days.select(c).scalar() for c in ("n_dates", "cutoff"))
    side = _sides(F.col(fixed.DATE), random_side(df.columns, share), found)
    return df.withColumn("split", side).filter(F.col("split").isNotNull())


def split_by_date(df: DataFrame, share: float = fixed.TRAIN_SHARE):
    """(train, test) of the same split. The cutoff is fetched first, so that its filter reaches
    the scan."""
    days = date_cutoff(df, share).first()
    if (days["n_dates"] or 0) < fixed.MIN_SPLIT_DATES:
        return random_split(df, share)
    cutoff = F.lit(days["cutoff"])
    return df.filter(F.col(fixed.DATE) < cutoff), df.filter(F.col(fixed.DATE) >= cutoff)


# --- pipeline --------------------------------------------------------------------------


def build_pipeline(
    df: DataFrame,
    columns: list[str],
    label: str = fixed.LABEL,
    encode: str = "ordinal",
    unseen: str = "keep",
    **regression,
) -> Pipeline:
    """Index texts, impute numbers by their mean, assemble, fit a linear regression.

    `encode`: "ordinal" puts the index itself into the regression; "onehot" one column per
    value. `unseen` is what happens to texts that training never saw: "keep" or "skip".
    `regression` overrides the ridge settings; `regParam=0.0` is ordinary least squares.
    """
    numeric, texts = by_type(df, columns)
    indexed = [f"{c}_indexed" for c in texts]
    imputed = [f"{c}_imputed" for c in numeric]
    stages = []
    if texts:
        stages.append(StringIndexer(inputCols=texts, outputCols=indexed, handleInvalid=unseen))
    if numeric:
        stages.append(Imputer(inputCols=numeric, outputCols=imputed))
    inputs = imputed + indexed
    if encode == "onehot" and texts:
        vectors = [f"{c}_vector" for c in texts]
        stages.append(
            OneHotEncoder(inputCols=indexed, outputCols=vectors, handleInvalid="keep")
        )
        inputs = imputed + vectors
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    stages.append(
        LinearRegression(
            featuresCol="features", labelCol=label, predictionCol="prediction",
            **{**fixed.REGRESSION, **regression},
        )
    )
    return Pipeline(stages=stages)


def value_counts(df: DataFrame, columns: list[str]) -> tuple[int, dict[str, int]]:
    """Number of rows, and of values per column, in one pass."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns]
    ).first().asDict()
    return counts.pop("_rows"), counts


# --- metrics ---------------------------------------------------------------------------


def regression_metrics(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """RMSE, R2 and MAE in one pass over the scored rows."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    sums = scored.filter(y.isNotNull() & F.col(prediction).isNotNull()).agg(
        F.count("*").alias("rows"),
        F.avg(error * error).alias("_mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("_variance"),
    )
    return sums.select(
        "rows",
        F.sqrt("_mse").alias("rmse"),
        "mae",
        F.when(F.col("_variance") > 0, 1 - F.col("_mse") / F.col("_variance")).alias("r2"),
    )


# --- whole training ----------------------------------------------------------------------


@dataclass
class Trained:
    model: PipelineModel
    columns: list[str]
    predictions: DataFrame
    metrics: dict[str, float]
    train_rows: int
    test_rows: int


def train_and_score(
    features: DataFrame, label: str = fixed.LABEL, encode: str = "ordinal", **regression
) -> Trained:
    """Fit on the earlier dates, score the later ones.

    The frame is written once: every fit step and metric is a pass over it.
    """
    data = written(training_frame(features, label), "training")
    train, test = split_by_date(data)
    train_rows, filled = value_counts(train, feature_columns(data.columns, label))
    # imputing a column without any value is an error, so such columns stay out
    columns = [c for c, n in filled.items() if n > 0]
    model = build_pipeline(data, columns, label, encode, **regression).fit(train)
    predictions = model.transform(test)
    measured = regression_metrics(predictions, label).first().asDict()
    metrics = {
        name: math.nan if measured[name] is None else measured[name]
        for name in ("rmse", "mae", "r2")
    }
    return Trained(model, columns, predictions, metrics, train_rows, measured["rows"])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def one_feature_line(df: DataFrame, x: str, y: str, **regression) -> PipelineModel:
    """Regression of `y` on one number column, as a fitted pipeline."""
    return build_pipeline(df, [x], y, **regression).fit(df)


@dataclass
class GramRidge:
    """A ridge regression in closed form: one coefficient a column, and the intercept."""

    columns: list[str]
    coefficients: list[float]
    intercept: float

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Null where a feature is null."""
        terms = [F.col(c).cast("double") * F.lit(b) for c, b in zip(self.columns, self.coefficients)]
        return df.withColumn(output, reduce(add, terms, F.lit(self.intercept)))


def gram_ridge(df: DataFrame, columns: list[str], label: str, reg: float = fixed.REGRESSION["regParam"]) -> GramRidge:
    """The fit of `LinearRegression` without iterations: sums of products in one pass, solved once.

    Features and label are scaled to unit deviation, and the penalty is given in label units, as there.
    Sums are taken about the first row's values, which keeps them small; rows with a null in a feature or
    the label are left out. Constant features have coefficient 0. The driver gets one row of
    (k + 1)(k + 4) / 2 numbers for k features, and solves k equations.
    """
    names = [*columns, label]
    rows = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)]).na.drop()
    first = rows.first()
    k = len(columns)
    if first is None:
        raise ValueError("no rows to fit")
    x = [F.col(f"_{i}") - F.lit(first[i]) for i in range(k + 1)]
    pairs = [(i, j) for i in range(k + 1) for j in range(i + 1)]
    sums = rows.agg(
        F.count("*").alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(k + 1)],
        *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs],
    ).first()
    mean = np.array([sums[f"s{i}"] for i in range(k + 1)]) / sums["n"]
    gram = np.zeros((k + 1, k + 1))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = sums[f"p{i}_{j}"] / sums["n"] - mean[i] * mean[j]
    deviation = np.sqrt(np.maximum(np.diag(gram), 0))
    live = np.flatnonzero(deviation[:k] > 1e-12 * np.maximum(1, np.abs(mean[:k])))
    beta = np.zeros(k)
    if deviation[k] > 0 and len(live):
        scale = deviation[live]
        correlation = gram[np.ix_(live, live)] / np.outer(scale, scale)
        right = gram[live, k] / (scale * deviation[k])
        penalty = np.eye(len(live)) * (reg / deviation[k])
        solved = np.linalg.lstsq(correlation + penalty, right, rcond=None)[0]
        beta[live] = solved * deviation[k] / scale
    base = np.array(first[:k], float)
    intercept = mean[k] + first[k] - float(beta @ (mean[:k] + base))
    return GramRidge(list(columns), [float(b) for b in beta], float(intercept))


def ridge_slope(slope: float, label_deviation: float, reg: float) -> float:
    """The one-feature ridge slope that belongs to an unregularised slope.

    Features and label are scaled to unit deviation and the penalty is given in label units.
    """
    return slope / (1.0 + reg / label_deviation) if label_deviation else math.nan
