"""Index of texts whose labels are a table: nothing is held on the driver, however many there are."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylag.operators.ranking import label_index
from skylag.session import written

LABELS = "labels"


class _Params(HasInputCol, HasOutputCol, HasHandleInvalid):
    pass


class TableIndexer(Estimator, _Params, MLWritable, MLReadable):
    """Texts to indices, the most frequent first, ties by text; an equal of the built-in indexer.

    `handleInvalid` is what happens to nulls and to texts that were not there at the fit: "keep" gives
    them the index after the last label, "skip" leaves their rows out, "error" ends the job.
    """

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, handleInvalid="keep"):
        super().__init__()
        self._setDefault(handleInvalid="keep")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TableIndexerModel:
        texts = dataset.select(F.col(self.getInputCol()).cast("string").alias("label"))
        labels = label_index(texts, "label").select("label", F.col("label_index").cast("double").alias("label_index"))
        return self._copyValues(TableIndexerModel(written(labels, LABELS)))

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class TableIndexerModel(Model, _Params, MLWritable, MLReadable):
    """The labels as a table (label, label_index), which is joined to what is transformed."""

    def __init__(self, labels: DataFrame | None = None):
        super().__init__()
        self._setDefault(handleInvalid="keep")
        self.labels = labels

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, text = self.getOutputCol(), F.col(self.getInputCol()).cast("string")
        kept = dataset.columns
        labels = self.labels.select(F.col("label").alias("_label"), F.col("label_index").alias("_index"))
        rows = dataset.withColumn("_text", text)
        how = self.getOrDefault("handleInvalid")
        if how == "skip":
            return rows.join(labels, F.col("_text") == F.col("_label")).select(*kept, F.col("_index").alias(out))
        joined = rows.join(labels, F.col("_text") == F.col("_label"), "left")
        if how == "error":
            message = F.concat(F.lit("a text that has no index: "), F.coalesce("_text", F.lit("null")))
            index = F.coalesce("_index", F.raise_error(message).cast("double"))
        else:
            # one number; the labels are never collected
            size = self.labels.select(F.count("*").cast("double").alias("n"))
            index = F.coalesce("_index", size.scalar())
        return joined.select(*kept, index.alias(out))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)


class _ModelWriter(MLWriter):
    def __init__(self, instance: TableIndexerModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.labels.write.parquet(f"{path}/{LABELS}")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/{LABELS}"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
