"""Pipeline stages around the encoder and the hourly models.

``CategoryEncoder`` (estimator), ``HourFeatures`` and ``HourModels`` (transformers) take
part in an MLlib ``Pipeline`` with MLlib's own stages, and are saved and loaded with it.
Feature vectors are sparse and made by MLlib's encoder and assembler in the JVM.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from . import encode, model


class _Fields(Params):
    inputCols = Param(Params._dummy(), "inputCols", "categorical columns in one-hot order", TypeConverters.toListString)
    unseen = Param(Params._dummy(), "unseen", "what to do with a value that the mapping lacks: fail, skip or null", TypeConverters.toString)

    def fields(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class CategoryEncoder(Estimator, _Fields, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the value mapping of all fields in one pass."""

    @keyword_only
    def __init__(self, *, inputCols=None, unseen="fail"):
        super().__init__()
        self._setDefault(unseen="fail")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryEncoderModel:
        return self._copyValues(CategoryEncoderModel(encode.fit(dataset, self.fields())))


class _WithTableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/table")


class _WithTableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls(self.sparkSession.read.schema(self.cls.SCHEMA).parquet(f"{path}/table"))
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out


class _WithTable(MLReadable, MLWritable):
    """A stage whose state is one table, saved as Parquet beside its parameters."""

    table: DataFrame

    def write(self) -> MLWriter:
        return _WithTableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _WithTableReader(cls)


class CategoryEncoderModel(Model, _Fields, _WithTable):
    """Adds ``pos_<field>``, the one-hot position of every field, with the number of
    levels and the first position in its column's metadata."""

    SCHEMA = encode.MAPPING_SCHEMA

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._setDefault(unseen="fail")
        self.table = table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fields = self.fields()
        out = encode.apply(dataset, self.table, fields, on_unseen=self.getOrDefault(self.unseen))
        levels = {r.field: {"levels": r.n_levels, "offset": r.offset} for r in encode.level_counts(self.table).collect()}  # a row a field
        for f in fields:
            out = out.withMetadata(f"pos_{f}", levels.get(f, {"levels": 0, "offset": 0}))
        return out


class HourFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``features``, a sparse vector of one-hot levels and the other 23 hours' log
    volumes in the order of the models' weights, and ``label``, the hour's own."""

    fields = Param(Params._dummy(), "fields", "encoded categorical columns", TypeConverters.toListString)
    volumes = Param(Params._dummy(), "volumes", "the 24 volume columns", TypeConverters.toListString)
    hour = Param(Params._dummy(), "hour", "hour of the label", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, fields=None, volumes=None, hour=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fields, volumes, hour = (self.getOrDefault(p) for p in (self.fields, self.volumes, self.hour))
        out = dataset.withColumn("_logs", F.array(*[C.log_volume(v) for v in volumes]))
        label, others = model.label_and_features(F.col("_logs"), hour)
        out = out.withColumns({"label": label, "_others": array_to_vector(others)})
        for f in fields:
            known = dataset.schema[f"pos_{f}"].metadata
            if "levels" not in known:
                raise ValueError(f"pos_{f} has no levels in its metadata: encode with CategoryEncoder")
            index = (F.col(f"pos_{f}") - F.lit(known["offset"])).cast("double")
            out = out.withColumn(f"_i_{f}", index).withMetadata(f"_i_{f}", {"ml_attr": {"type": "nominal", "name": f, "num_vals": known["levels"]}})
        names = [f"_i_{f}" for f in fields]
        hot = [f"_h_{f}" for f in fields]
        encoder = OneHotEncoder(inputCols=names, outputCols=hot, dropLast=False)
        out = encoder.fit(out).transform(out)  # sizes come from the metadata, no pass over the rows
        out = VectorAssembler(inputCols=[*hot, "_others"], outputCol="features").transform(out)
        return out.drop("_logs", "_others", *names, *hot)


class HourModels(Model, _WithTable):
    """The 24 hourly models: adds ``prediction`` for the label's hour from ``features``."""

    SCHEMA = model.MODEL_SCHEMA
    hour = Param(Params._dummy(), "hour", "hour that is predicted", TypeConverters.toInt)

    def __init__(self, table: DataFrame | None = None, hour: int | None = None):
        super().__init__()
        self.table = table
        if hour is not None:
            self._set(hour=hour)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        one = self.table.where(F.col("hour") == self.getOrDefault(self.hour)).select(
            F.col("intercept").alias("_intercept"), F.col("coef").alias("_coef"))
        dot = F.aggregate(F.zip_with(vector_to_array("features"), F.col("_coef"), lambda x, w: x * w), F.lit(0.0), lambda s, t: s + t)
        return dataset.crossJoin(F.broadcast(one)).withColumn("prediction", F.col("_intercept") + dot).drop("_intercept", "_coef")
