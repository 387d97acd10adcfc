"""Feature importance per model, across models and by feature type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.naming import feature_type
from ..sources.session import materialize
from .split import row_hash

# Importance tables have one row per (model, feature): their size is the number of features,
# so windows over a model, or over all rows of such a table, stay small.


#: Bytes of the rows whose values replace those of other rows; they are sent to every task.
DONOR_BYTES = 16 << 20


def normalized(rows: DataFrame, value: str = "importance") -> DataFrame:
    """Importance divided by its sum within a model; unchanged when the sum is not positive."""
    total = F.sum(value).over(Window.partitionBy("model"))
    return rows.withColumn(value, F.when(total > 0, F.col(value) / total).otherwise(F.col(value)))


def _table(spark, model: str, names: Sequence[str], values) -> DataFrame:
    rows = [(model, n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "model STRING, feature STRING, importance DOUBLE")


def linear_importance(spark, model, names: Sequence[str], label: str = "ridge") -> DataFrame:
    """Absolute coefficients, normalised."""
    return normalized(_table(spark, label, names, np.abs(model.coefficients.toArray())))


def tree_importance(spark, model, names: Sequence[str], label: str) -> DataFrame:
    """Impurity importance of a tree ensemble, normalised."""
    return normalized(_table(spark, label, names, model.featureImportances.toArray()))


class LinearScorer:
    """Predictions of a linear model when one feature changes."""

    def __init__(self, coefficients: np.ndarray, intercept: float):
        self.coefficients, self.intercept = coefficients, intercept

    def start(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(what ``changed`` starts from, predictions)."""
        p = x @ self.coefficients + self.intercept
        return p, p

    def changed(self, state: np.ndarray, feature: int, by: np.ndarray) -> np.ndarray:
        """Predictions of the rows with ``by`` added to one feature."""
        return state + self.coefficients[feature] * by


def scorer(model):
    """What scores a fitted model's rows inside a task, one changed feature at a time."""
    if hasattr(model, "scorer"):
        return model.scorer()
    if hasattr(model, "coefficients"):
        return LinearScorer(model.coefficients.toArray(), float(model.intercept))
    raise TypeError(f"{type(model).__name__} cannot be scored in place; linear models and networks can")


def _vectors(rows: DataFrame, features: str, label: str) -> DataFrame:
    return rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), "code").filter(F.col("y").isNotNull())


def _arrays(batch, width: int) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return x, batch.column("y").to_numpy(zero_copy_only=False)


def _mixed(code: np.ndarray, repeat: int) -> np.ndarray:
    """Well-spread numbers from row codes and a repeat."""
    h = code.astype(np.uint64) + np.uint64(repeat * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def _donors(rows: DataFrame, n: int, width: int) -> np.ndarray:
    """Feature values of all rows, or of those with the smallest codes, about DONOR_BYTES of them."""
    most = max(1, DONOR_BYTES // (8 * width))
    if n > most:
        # Codes are spread evenly over the longs; the margin keeps the pool from being empty.
        rows = rows.filter(F.col("code") < -(1 << 63) + ((1 << 64) - 1) * min(most + 10, n) // n)
    found = rows.select("x", "code").toArrow()
    x = found["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    order = np.lexsort((*x.T[::-1], found["code"].to_numpy())) if width <= 32 else np.argsort(found["code"].to_numpy(), kind="stable")
    return x[order]


def permutation_importance(
    model, df: DataFrame, key: str, names: Sequence[str], features: str = "features", label: str = "label",
    name: str = "network", rows: int | None = None, repeats: int = fixed.PERMUTATION["repeats"],
    seed: int = fixed.SEED,
) -> DataFrame:
    """Mean loss of R2 when one feature's values come from other rows, normalised; over all rows, or a sample of ``rows``.

    Every row is scored in the task that reads it, once as it is and then with one feature changed in
    place; no row is copied or shuffled. The other values come from donors, rows picked by a hash of their
    key: all rows, or as many as DONOR_BYTES hold. A task sends one sum of squares per feature and repeat,
    so what is shuffled does not depend on the number of rows. Linear models and networks can be scored so.
    A table without rows has no importances; rows without a label are left out.
    """
    spark, width = df.sparkSession, len(names)
    chosen = df
    if rows is not None:
        chosen = df.filter(F.col(label).isNotNull()).orderBy(row_hash(key, seed), key).limit(rows)
    chosen = materialize(_vectors(chosen.withColumn("code", F.xxhash64(F.col(key), F.lit(seed))), features, label), "permutation")
    head = chosen.agg(F.count("y").alias("n"), F.avg("y").alias("mean")).first()
    if not head["n"]:
        return _table(spark, name, [], [])
    in_place, shared = scorer(model), spark.sparkContext.broadcast(_donors(chosen, head["n"], width))

    def score(batches):
        donors, sums = shared.value, np.zeros((repeats, 4 + width))
        for batch in batches:
            x, y = _arrays(batch, width)
            if not len(x):
                continue
            state, p = in_place.start(x)
            code = batch.column("code").to_numpy(zero_copy_only=False)
            shifted = y - head["mean"]
            sums[:, :4] += [len(y), shifted.sum(), shifted @ shifted, (y - p) @ (y - p)]
            for repeat in range(repeats):
                donor = (_mixed(code, repeat) % np.uint64(len(donors))).astype(np.int64)
                for feature in range(width):
                    error = y - in_place.changed(state, feature, donors[donor, feature] - x[:, feature])
                    sums[repeat, 4 + feature] += error @ error
        yield pa.RecordBatch.from_pydict({"repeat": pa.array(range(repeats), pa.int32()), "sums": pa.array(list(sums), pa.list_(pa.float64()))})

    parts = chosen.mapInArrow(score, "repeat INT, sums ARRAY<DOUBLE>")
    found = parts.groupBy("repeat").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).toPandas()
    shared.destroy()
    sums = np.stack(found.sort_values("repeat")["sums"])
    spread = sums[0, 2] - sums[0, 1] ** 2 / sums[0, 0]
    drops = (sums[:, 4:].mean(axis=0) - sums[0, 3]) / (spread or 1.0)
    return normalized(_table(spark, name, names, drops))


def expected_permutation_importance(
    model, df: DataFrame, names: Sequence[str], features: str = "features", label: str = "label", name: str = "ridge",
) -> DataFrame:
    """The mean of ``permutation_importance`` over all permutations, for a linear model, normalised.

    With error e and coefficient w the squared errors grow by 2 w sum(e (x - mean)) + 2 n w^2 var(x) on
    average, so three sums per feature are enough: one scan for means, one for the sums.
    """
    spark, width = df.sparkSession, len(names)
    rows = _vectors(df.withColumn("code", F.lit(0)), features, label)
    head = rows.groupBy(F.lit(1)).agg(Summarizer.mean(array_to_vector("x")).alias("x"), F.avg("y").alias("y")).first()
    if head is None:
        return _table(spark, name, [], [])
    w, linear, mean, y_mean = model.coefficients.toArray(), scorer(model), head["x"].toArray(), head["y"]

    def add(batches):
        sums = np.zeros((3, width))
        for batch in batches:
            x, y = _arrays(batch, width)
            if len(x):
                e, z, y = y - linear.start(x)[1], x - mean, y - y_mean
                sums += np.stack([e @ z, (z * z).sum(axis=0), np.full(width, y @ y)])
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(3), pa.int32()), "sums": pa.array(list(sums), pa.list_(pa.float64()))})

    found = rows.mapInArrow(add, "i INT, sums ARRAY<DOUBLE>").groupBy("i").agg(
        vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")
    ).toPandas()
    ez, zz, yy = np.stack(found.sort_values("i")["sums"])
    drops = (2 * w * ez + 2 * w * w * zz) / np.where(yy > 0, yy, 1.0)
    return normalized(_table(spark, name, names, drops))


def with_type(rows: DataFrame, prefixes: Sequence[str] | None = None) -> DataFrame:
    kind = feature_type("feature") if prefixes is None else feature_type("feature", prefixes)
    return rows.withColumn("feature_type", kind)


def type_importance(rows: DataFrame) -> DataFrame:
    """(model, feature_type, importance) summed within a model."""
    return rows.groupBy("model", "feature_type").agg(F.sum("importance").alias("importance"))


def average_importance(rows: DataFrame) -> DataFrame:
    """(feature, feature_type, importance, models): mean over the models that report it."""
    return rows.groupBy("feature", "feature_type").agg(
        F.avg("importance").alias("importance"), F.count(F.lit(1)).alias("models")
    )


def ranked(df: DataFrame, value: str, tie: str, n: int, descending: bool = True) -> DataFrame:
    """The first n rows by a value with their rank."""
    order = [F.desc(value) if descending else F.asc(value), F.asc(tie)]
    top = df.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_features(rows: DataFrame, n: int = 30) -> DataFrame:
    return ranked(average_importance(rows), "importance", "feature", n)


def top_per_model(rows: DataFrame, n: int = 20) -> DataFrame:
    """The n most important features of each model."""
    w = Window.partitionBy("model").orderBy(F.desc("importance"), "feature")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def consistent_features(rows: DataFrame, per_model: int = 20, least: int = 2) -> DataFrame:
    """(feature, models): features among the top of at least ``least`` models."""
    top = top_per_model(rows, per_model)
    return top.groupBy("feature").agg(F.count(F.lit(1)).alias("models")).filter(F.col("models") >= least)


def average_type_importance(rows: DataFrame) -> DataFrame:
    """(feature_type, importance, percent): mean over the models having the type, and its share."""
    means = type_importance(rows).groupBy("feature_type").agg(F.avg("importance").alias("importance"))
    total = F.sum("importance").over(Window.partitionBy())
    percent = F.when(total > 0, F.col("importance") / total * 100.0).otherwise(0.0)
    return means.withColumn("percent", percent)


def importance_matrix(rows: DataFrame, types: Sequence[str]) -> DataFrame:
    """One row per model, one column per feature type; an absent type is 0."""
    return rows.groupBy("model").pivot("feature_type", list(types)).agg(F.sum("importance")).fillna(0.0)


def main_type(rows: DataFrame) -> DataFrame:
    """(model, feature_type, importance): each model's most important type."""
    best = F.max_by(F.struct("feature_type", "importance"), F.struct("importance", "feature_type"))
    return type_importance(rows).groupBy("model").agg(best.alias("b")).select("model", "b.*")


def recommendations(rows: DataFrame) -> DataFrame:
    """(rule, subject, value): which advice the importances support."""
    def rule(df: DataFrame, name: str, subject: str, value: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("rule"), F.col(subject).alias("subject"), F.col(value).cast("double").alias("value")
        )

    types = average_type_importance(rows)
    best, worst = F.desc("importance"), F.asc("importance")
    out = [
        rule(types.orderBy(best, "feature_type").limit(1), "top_type", "feature_type", "importance"),
        rule(
            types.orderBy(worst, F.desc("feature_type")).limit(1)
            .filter(F.col("importance") < fixed.LOW_TYPE_IMPORTANCE)
            .filter(types.select(F.count(F.lit(1))).scalar() > 1),
            "remove_type", "feature_type", "importance",
        ),
        rule(top_features(rows, 10), "top_feature", "feature", "importance"),
        rule(
            consistent_features(rows).orderBy(F.desc("models"), "feature").limit(5),
            "consistent_feature", "feature", "models",
        ),
        rule(main_type(rows), "main_type_of_model", "model", "importance"),
    ]
    for kind, threshold in fixed.HIGH_TYPE_IMPORTANCE.items():
        strong = types.filter((F.col("feature_type") == kind) & (F.col("importance") > threshold))
        out.append(rule(strong, "strong_type", "feature_type", "importance"))
    width = rows.agg(F.count_distinct("feature").alias("n")).filter(F.col("n") > fixed.MANY_FEATURES)
    out.append(rule(width.withColumn("s", F.lit("features")), "reduce_features", "s", "n"))
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


def union_all(parts: Mapping[str, DataFrame] | Sequence[DataFrame]) -> DataFrame:
    """Importance tables of several models as one."""
    parts = list(parts.values()) if isinstance(parts, Mapping) else list(parts)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
