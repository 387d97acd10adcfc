"""Feature assembly, scaling and the regression models."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Model
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.regression import GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.cells import number, number_or_zero, positive_number
from ..functions.sparse import entries
from ..sources.session import materialize
from .forest import ForestRegressor

# Beyond this many features MLlib's normal-equation solver is not available.
NORMAL_SOLVER_FEATURES = 4096


def typed_features(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows with a target above zero; unreadable or missing feature cells become 0."""
    label = number(df, target)
    return df.filter(positive_number(label)).select(
        *keys, *[number_or_zero(df, c).alias(c) for c in features], label.alias("label")
    )


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """One vector column instead of many scalar ones."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep").transform(df)


class PopulationScaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Centres and divides by the population standard deviation; constant features are only centred."""

    def __init__(self, inputCol="features", outputCol="scaled"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        stats = dataset.agg(
            Summarizer.metrics("mean", "variance", "count").summary(F.col(self.getInputCol())).alias("s")
        ).first()["s"]
        n = stats["count"]
        # MLlib reports the sample variance.
        stds = [(v * (n - 1) / n) ** 0.5 for v in stats["variance"].toArray()]
        return PopulationScalerModel(
            self.getInputCol(), self.getOutputCol(),
            [float(m) for m in stats["mean"].toArray()], [float(s) if s > 0 else 1.0 for s in stds],
        )


class PopulationScalerModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean per feature", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "divisor per feature", TypeConverters.toListFloat)

    def __init__(self, inputCol="features", outputCol="scaled", means=(), scales=()):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, means=list(means), scales=list(scales))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        centred = F.zip_with(
            vector_to_array(self.getInputCol()), F.lit(self.getOrDefault("means")), lambda x, m: x - m
        )
        scaled = F.zip_with(centred, F.lit(self.getOrDefault("scales")), lambda x, s: x / s)
        return dataset.withColumn(self.getOutputCol(), array_to_vector(scaled))


def least_squares(features: str = "features", label: str = "label") -> LinearRegression:
    """Ordinary least squares with an intercept."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver="auto")


class Ridge(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares plus alpha times the squared coefficients (intercept not penalised).

    MLlib scales its penalty by the label's standard deviation and the number of rows; that is
    undone here, so the coefficients solve (X'X + alpha I) w = X'y on centred data. Beyond
    ``NORMAL_SOLVER_FEATURES`` the same equations are solved by conjugate gradients.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)

    def __init__(self, featuresCol="features", labelCol="label", alpha=fixed.RIDGE_ALPHA):
        super().__init__()
        self._set(featuresCol=featuresCol, labelCol=labelCol, alpha=alpha)

    def _fit(self, dataset: DataFrame) -> LinearRegressionModel:
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        raw = F.unwrap_udt(F.col(features))
        width = F.coalesce(raw["size"], F.size(raw["values"]))
        y = dataset.agg(
            F.count(label).alias("n"), F.stddev_pop(label).alias("pop"), F.max(width).alias("width"),
        ).first()
        if y["width"] is not None and y["width"] > NORMAL_SOLVER_FEATURES:
            return self._conjugate_gradients(dataset.filter(F.col(label).isNotNull()), features, label)
        penalty = self.getOrDefault("alpha") * (y["pop"] or 1.0) / y["n"]
        return LinearRegression(
            featuresCol=features, labelCol=label, elasticNetParam=0.0, regParam=penalty,
            standardization=False, solver="normal",
        ).fit(dataset)

    def _conjugate_gradients(self, dataset: DataFrame, features: str, label: str) -> LinearRegressionModel:
        """The same solution without the d x d matrix: each step is one scan that multiplies it with a vector.

        Rows are written once as their stored entries, so a step costs what the non-zeros cost; a task sends one
        vector. The diagonal of the matrix scales the steps.
        """
        spark, alpha = dataset.sparkSession, self.getOrDefault("alpha")
        head = dataset.groupBy(F.lit(1)).agg(
            Summarizer.metrics("mean", "variance", "count").summary(F.col(features)).alias("s"), F.avg(label).alias("y"),
        ).first()
        mean, n, y_mean = head["s"]["mean"].toArray(), head["s"]["count"], head["y"]
        spread = head["s"]["variance"].toArray() * (n - 1)
        rows = materialize(dataset.select(
            F.transform(entries(features), lambda e: e["index"]).alias("i"),
            F.transform(entries(features), lambda e: e["value"]).alias("x"), (F.col(label) - F.lit(y_mean)).alias("y"),
        ), "ridge-rows")

        def product(v: np.ndarray | None) -> np.ndarray:
            """X'(Xv) of the rows as they are, or X'y."""
            shared = spark.sparkContext.broadcast(v)

            def multiply(batches):
                held, total = shared.value, np.zeros(len(mean) + 1)
                for batch in batches:
                    i, x, y = batch.columns
                    lengths = pc.list_value_length(i).to_numpy(zero_copy_only=False)
                    owner = np.repeat(np.arange(len(lengths)), lengths)
                    places, values = (c.flatten().to_numpy(zero_copy_only=False) for c in (i, x))
                    by_row = y.to_numpy(zero_copy_only=False) if held is None else np.bincount(owner, values * held[places], len(lengths))
                    total[:-1] += np.bincount(places, values * by_row[owner], len(mean))
                    total[-1] += by_row.sum()
                yield pa.RecordBatch.from_pydict({"v": pa.array([total], pa.list_(pa.float64()))})

            parts = rows.mapInArrow(multiply, "v ARRAY<DOUBLE>")
            found = parts.agg(Summarizer.sum(array_to_vector("v")).alias("v")).first()["v"].toArray()
            shared.destroy()
            return found

        def apply(v: np.ndarray) -> np.ndarray:
            found = product(v)
            # Centring takes the means away from rows and columns: sum x (x - mean)'v.
            return found[:-1] - n * mean * (mean @ v) + alpha * v

        right = product(None)
        right = right[:-1] - mean * right[-1]
        scale = spread + alpha
        w, residual = np.zeros(len(mean)), right.copy()
        z = residual / scale
        direction, size = z.copy(), residual @ z
        goal = 1e-13 * np.linalg.norm(right)
        for _ in range(10 * len(mean)):
            if np.linalg.norm(residual) <= goal or size <= 0:
                break
            turned = apply(direction)
            step = size / (direction @ turned)
            w += step * direction
            residual -= step * turned
            z = residual / scale
            size, before = residual @ z, size
            direction = z + size / before * direction
        jvm = spark.sparkContext._jvm
        made = jvm.org.apache.spark.ml.regression.LinearRegressionModel(
            f"LinearRegression_{uuid.uuid4().hex[:12]}", _py2java(spark.sparkContext, Vectors.dense(w)), float(y_mean - mean @ w), 1.0,
        )
        made.setFeaturesCol(features)
        return LinearRegressionModel(made)


def forest(features: str = "features", label: str = "label", **changes) -> ForestRegressor:
    return ForestRegressor(features, label, **changes)


def boosting(features: str = "features", label: str = "label", **changes) -> GBTRegressor:
    s = fixed.BOOSTING | changes
    return GBTRegressor(
        featuresCol=features, labelCol=label, maxIter=s["trees"], maxDepth=s["depth"], stepSize=s["step"],
        subsamplingRate=s["row_share"], featureSubsetStrategy=str(s["column_share"]), seed=fixed.SEED,
        # One shallow tree at a time is walked faster than a new table of the rows' node ids is kept for every level.
        maxMemoryInMB=1024, cacheNodeIds=False, checkpointInterval=10,
    )


def coefficients(model: LinearRegressionModel, names: Sequence[str]) -> DataFrame:
    """(feature, coefficient) of a linear model."""
    from pyspark.sql import SparkSession

    rows = [(n, float(c)) for n, c in zip(names, model.coefficients)]
    return SparkSession.active().createDataFrame(rows, "feature STRING, coefficient DOUBLE")


def top_coefficients(model: LinearRegressionModel, names: Sequence[str], n: int = 20, by_size: bool = True) -> DataFrame:
    """The n largest coefficients, by magnitude or by value; the sign is kept."""
    order = F.desc(F.abs("coefficient")) if by_size else F.desc("coefficient")
    return coefficients(model, names).orderBy(order, "feature").limit(n)
