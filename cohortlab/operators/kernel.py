"""L2: random Fourier features as a pipeline stage, so that a linear machine becomes an rbf one.

Rahimi and Recht (2007): ``sqrt(2 / D) cos(W x + b)`` with normal ``W`` of variance ``2 gamma`` and uniform ``b`` has
inner products close to ``exp(-gamma |x - y|^2)``. The drawn map is a function of (seed, dimension, gamma, D), which are
parameters of the fitted stage: it is saved and loaded with the pipeline model and runs on a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _RbfParams(HasInputCol, HasOutputCol, HasSeed):
    numFeatures = Param(Params._dummy(), "numFeatures", "size of the feature map", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "'scale', 'auto' or a number", TypeConverters.identity)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(inputCol="features", outputCol="rbf", seed=42, numFeatures=128, gamma="scale")


class RbfFeatures(Estimator, _RbfParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the kernel width. ``gamma``: 'scale' is 1 / (dimension x variance of all entries), 'auto' 1 / dimension,
    else a positive number. One aggregation; entries without variance give 'scale' the width 1."""

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="rbf", seed=42, numFeatures=128, gamma="scale"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "RbfFeaturesModel":
        col, gamma = self.getInputCol(), self.getOrDefault(self.gamma)
        summary = Summarizer.metrics("count", "sum", "normL2").summary(F.col(col)).alias("s")
        got = df.where(F.col(col).isNotNull()).groupBy(F.lit(1)).agg(summary).select("s.*").first()  # no row for an empty table
        if got is None:
            raise ValueError("rbf features need at least one row")
        dim = len(got["sum"])
        n = got["count"] * dim
        variance = float((got["normL2"].toArray() ** 2).sum() / n - (got["sum"].toArray().sum() / n) ** 2)
        if gamma == "scale":
            width = 1.0 / (dim * variance) if variance > 0 else 1.0
        elif gamma == "auto":
            width = 1.0 / dim
        elif isinstance(gamma, (int, float)) and gamma > 0:
            width = float(gamma)
        else:
            raise ValueError(f"gamma must be 'scale', 'auto' or a positive number, not {gamma!r}")
        model = RbfFeaturesModel(dim=dim, width=width)
        return model._set(inputCol=col, outputCol=self.getOutputCol(), seed=self.getSeed(), numFeatures=self.getOrDefault(self.numFeatures),
                          gamma=gamma)


class RbfFeaturesModel(Model, _RbfParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the feature map of ``inputCol`` as the vector ``outputCol``, in Arrow batches. A null vector stays null, one of another
    size raises."""

    dim = Param(Params._dummy(), "dim", "dimension of the input", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "kernel width", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, dim=None, width=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def drawn(self) -> tuple[np.ndarray, np.ndarray]:
        """The map: frequencies (dimension x features) and phases."""
        rng = np.random.default_rng(self.getSeed())
        d, size = self.getOrDefault(self.dim), self.getOrDefault(self.numFeatures)
        return rng.normal(0.0, np.sqrt(2 * self.getOrDefault(self.width)), (d, size)), rng.uniform(0, 2 * np.pi, size)

    def _transform(self, df: DataFrame) -> DataFrame:
        w, b = self.drawn()
        scale = np.sqrt(2.0 / len(b))

        @F.pandas_udf("array<double>")
        def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                there = x.dropna()
                mapped = list(scale * np.cos(np.vstack(there.to_list()) @ w + b)) if len(there) else []
                yield pd.Series(mapped, index=there.index, dtype=object).reindex(x.index)

        return df.withColumn(self.getOutputCol(), array_to_vector(features(vector_to_array(F.col(self.getInputCol())))))
