"""Station dimension and station lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylag import fixed, schemas
from skylag.functions import text
from skylag.operators.checks import required_columns
from skylag.sources.files import CSV_OPTIONS


def load_stations(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Stations from a CSV or JSON file (by suffix), or the default list without a path.

    A coordinate that is not a number, a missing column and an empty list are errors.
    """
    if path is None:
        return spark.createDataFrame(list(fixed.DEFAULT_STATIONS), schemas.STATIONS)
    if path.lower().endswith(".json"):
        texts = ", ".join(f"{name} string" for name in schemas.STATIONS.fieldNames())
        rows = spark.read.schema(texts).json(path, multiLine=True, mode="FAILFAST")
    else:
        rows = spark.read.options(**CSV_OPTIONS).csv(path)
    required_columns(rows, *schemas.STATIONS.fieldNames())
    # a plain cast, which under ANSI rules fails on a text that is not a number
    stations = rows.select(*[F.col(f.name).cast(f.dataType) for f in schemas.STATIONS.fields])
    if stations.isEmpty():
        raise ValueError("station list is empty")
    return stations


def station_codes(lists: DataFrame, value: str = "value", default=None) -> DataFrame:
    """One row per station code of comma or line separated texts."""
    kept = [c for c in lists.columns if c != value]
    return lists.select(
        *kept, F.explode(text.station_list(value, default)).alias("station")
    )


def load_station_codes(spark: SparkSession, path: str | None) -> DataFrame:
    """Station codes of a text file; the default list for no file, a missing or an empty one."""
    whole = spark.createDataFrame([("",)], "value string")
    if path is not None:
        try:
            whole = spark.read.text(path, wholetext=True)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return station_codes(whole, "value", fixed.DEFAULT_METAR_STATIONS)
