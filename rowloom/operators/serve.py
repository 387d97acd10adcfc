"""Training a model for production, and scoring rows with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.cells import number, number_or_zero, prefix
from ..sources.session import materialize
from . import metrics, models, project
from .split import hash_split


def align(df: DataFrame, manifest: Sequence[str]) -> list[Column]:
    """The manifest's features as doubles, in order; 0 where absent or unreadable."""
    return [
        (number_or_zero(df, name) if name in df.columns else F.lit(0.0)).alias(name) for name in manifest
    ]


def align_long(cells: DataFrame, key: str, manifest: Sequence[str]) -> DataFrame:
    """(key, position, feature, value) for every key and manifest feature, from stored cells.

    Each row fans out over the manifest; cells meet it by (key, feature).
    """
    slots = cells.select(key).distinct().select(
        key, F.posexplode(F.lit(list(manifest))).alias("position", "feature")
    )
    return slots.join(cells.select(key, "feature", "value"), [key, "feature"], "left").select(
        key, "position", "feature", F.coalesce("value", F.lit(0.0)).alias("value")
    )


def production_pipeline(features: Sequence[str], regressor) -> Pipeline:
    """Assemble, scale, predict. The regressor must read the ``scaled`` column."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
        models.PopulationScaler("features", "scaled"),
        regressor,
    ])


def train(
    df: DataFrame, key: str, features: Sequence[str], target: str, regressor, share: float = fixed.TEST_SHARE,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training part; (model, (dataset, rows, mse, rmse, mae, r2, mape))."""
    # Fitting and scoring read the rows several times; they are parsed once.
    typed = materialize(models.typed_features(df, features, target, [key]), "train")
    if not project.enough_rows(typed):
        raise ValueError(f"fewer than {fixed.SMALLEST_SAMPLE} rows have a target above zero")
    training, test = hash_split(typed, key, share)
    model = production_pipeline(features, regressor).fit(training)
    both = model.transform(training).withColumn("dataset", F.lit("train")).unionByName(
        model.transform(test).withColumn("dataset", F.lit("test"))
    )
    scores = both.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("rows"), *metrics.score_columns("label", "prediction")
    )
    return model, scores


def score(
    df: DataFrame, model: PipelineModel, manifest: Sequence[str], key: str, target: str | None = None,
    title: str | None = None, company: str | None = None,
) -> DataFrame:
    """Predictions with errors where the actual value is known; one narrow projection per row."""
    labels = {
        "actual": number(df, target) if target else F.lit(None).cast("double"),
        "title": prefix(title, 60) if title else F.lit("N/A"),
        "company": prefix(company, 40) if company else F.lit("N/A"),
    }
    ready = df.select(F.col(key).alias("__key"), *[c.alias(f"__{n}") for n, c in labels.items()], *align(df, manifest))
    return prediction_report(
        model.transform(ready).select(
            F.col("__key").alias("row_index"), F.col("prediction").alias("predicted"),
            F.col("__actual").alias("actual"), F.col("__title").alias("title"), F.col("__company").alias("company"),
        )
    )


def score_at(df: DataFrame, row_id: str, k: int, model: PipelineModel, manifest: Sequence[str], target: str | None = None,
             **labels: str) -> DataFrame:
    """The prediction report of the row at 0-based position k of ``row_id``; IndexError beyond the table."""
    return score(project.row_at(df, row_id, k), model, manifest, row_id, target, **labels)


def prediction_report(df: DataFrame) -> DataFrame:
    """Add error and percent error; both null when the actual value is missing or 0."""
    known = F.coalesce(F.col("actual") != 0, F.lit(False))
    error = F.col("predicted") - F.col("actual")
    return df.select(
        "row_index", F.col("predicted").alias("predicted_salary"), F.col("actual").alias("actual_salary"),
        F.when(known, F.abs(error)).alias("error"),
        F.when(known, F.abs(error / F.col("actual") * 100.0)).alias("error_pct"),
        "title", "company",
    )


def mean_errors(predictions: DataFrame) -> DataFrame:
    """(rows, mean_error, mean_error_pct); rows without an error are left out of the means."""
    return predictions.agg(
        F.count("error").alias("rows"), F.avg("error").alias("mean_error"), F.avg("error_pct").alias("mean_error_pct")
    )
