"""Saving and loading fitted models with their feature list and metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_model(
    spark: SparkSession, model: PipelineModel, features: Sequence[str], scores: Mapping[str, float], path: str,
    settings: Mapping[str, object] | None = None,
) -> dict[str, str]:
    """Write model, ordered feature list and metadata below ``path``; returns the three paths."""
    paths = {name: f"{path}/{name}" for name in ("model", "features", "metadata")}
    model.write().overwrite().save(paths["model"])
    listed = spark.createDataFrame(list(enumerate(features)), "position INT, feature STRING")
    listed.coalesce(1).write.mode("overwrite").json(paths["features"])
    metadata = {
        "model_type": type(model.stages[-1]).__name__, "model_config": dict(settings or {}),
        "training_date": datetime.now(timezone.utc).isoformat(), "performance_metrics": dict(scores),
        "n_features": len(features),
        "feature_columns_file": "features", "model_file": "model", "scaler_file": "model",
    }
    text = spark.createDataFrame([(json.dumps(metadata),)], "value STRING")
    text.coalesce(1).write.mode("overwrite").text(paths["metadata"])
    return paths


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str], dict]:
    """(model, features in order, metadata); fails when a part is absent."""
    model = PipelineModel.load(f"{path}/model")
    rows = spark.read.schema("position INT, feature STRING").json(f"{path}/features").collect()
    metadata = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    return model, [r["feature"] for r in sorted(rows, key=lambda r: r["position"])], metadata


def save_vectors(table: DataFrame, path: str) -> None:
    """Write a (word, vec) table."""
    table.select("word", "vec").write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """A (word, vec) table and its vector length; fails when it is empty or ragged."""
    table = spark.read.parquet(path).select("word", "vec")
    from pyspark.sql import functions as F

    width = table.agg(F.min(F.size("vec")).alias("low"), F.max(F.size("vec")).alias("high")).first()
    if width["low"] is None or width["low"] != width["high"]:
        raise ValueError("word vectors must be present and of one length")
    return table, width["low"]
