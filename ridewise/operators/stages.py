"""Base of the library's own ``pyspark.ml`` stages.

A fitted stage is its params plus named arrays of numbers. It is stored like
any MLlib stage, metadata in the stage's folder, and keeps the arrays as a
parquet table beside it, so own and MLlib stages may share a ``PipelineModel``
that is saved to and loaded from any store Spark reads.
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import SparkSession

ARRAYS = "name string, kind string, shape array<int>, numbers array<double>"


class ColumnsIn(Params):
    """Param: the columns a stage reads."""
    inputCols = Param(Params._dummy(), "inputCols", "columns read", TypeConverters.toListString)

    def getInputCols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class ColumnOut(Params):
    """Param: the column a stage adds."""
    outputCol = Param(Params._dummy(), "outputCol", "column added", TypeConverters.toString)

    def getOutputCol(self) -> str:
        return self.getOrDefault(self.outputCol)


class StageParams(Params):
    def with_params(self, **kw):
        """The stage itself, after setting the given params."""
        return self._set(**{k: v for k, v in kw.items() if v is not None})


class TableEstimator(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """An estimator whose model is a ``TableModel``; subclasses add params and ``_fit``."""

    def _model(self, cls, arrays: dict[str, np.ndarray]):
        model = cls(arrays)
        for p in self.params:
            if model.hasParam(p.name) and self.isDefined(p):
                model._set(**{p.name: self.getOrDefault(p)})
        return model


class TableModel(Model, MLReadable, MLWritable):
    """A model that is its params and ``arrays``."""

    def __init__(self, arrays: dict[str, np.ndarray] | None = None):
        super().__init__()
        self.arrays = {k: np.asarray(v) for k, v in (arrays or {}).items()}

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.arrays = self.arrays
        return out


class _TableWriter(MLWriter):
    def __init__(self, instance: TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        DefaultParamsWriter.saveMetadata(self.instance, path, spark.sparkContext)
        rows = [(k, v.dtype.str, list(v.shape), v.astype(np.float64).ravel().tolist()) for k, v in self.instance.arrays.items()]
        spark.createDataFrame(rows, ARRAYS).write.mode("overwrite").parquet(f"{path}/data")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TableModel:
        spark = SparkSession.active()
        meta = DefaultParamsReader.loadMetadata(path, spark.sparkContext)
        rows = spark.read.parquet(f"{path}/data").collect()          # the model's own arrays
        model = self.cls({r["name"]: np.array(r["numbers"], dtype=np.float64).reshape(r["shape"]).astype(r["kind"]) for r in rows})
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


__all__ = ["ColumnOut", "ColumnsIn", "Param", "Params", "StageParams", "TableEstimator", "TableModel", "TypeConverters", "keyword_only"]
