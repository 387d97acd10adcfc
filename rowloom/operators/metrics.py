"""Scores and error diagnostics of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from . import order_stats


def score_columns(actual: Column | str, predicted: Column | str) -> list[Column]:
    """mse, rmse, mae, r2, mape (percent) as aggregates of one pass."""
    y = F.col(actual) if isinstance(actual, str) else actual
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    error = y - p
    mse = F.avg(error * error)
    return [
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
        (1.0 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
        (F.avg(F.abs(F.try_divide(error, y))) * 100.0).alias("mape"),
    ]


def regression_metrics(
    df: DataFrame, actual: str = "label", predicted: str = "prediction", by: Sequence[str] = (),
) -> DataFrame:
    """Scores over all rows or per group."""
    return df.groupBy(*by).agg(*score_columns(actual, predicted))


def residuals(df: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def absolute_errors(df: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    return df.withColumn("abs_error", F.abs(F.col(actual) - F.col(predicted)))


def error_percentiles(
    df: DataFrame, actual: str = "label", predicted: str = "prediction",
    percents: Sequence[int] = fixed.ERROR_PERCENTILES,
) -> DataFrame:
    """(percentile, abs_error) with linear interpolation."""
    errors = absolute_errors(df, actual, predicted).select("abs_error")
    values = order_stats.percentiles(errors, "abs_error", [p / 100 for p in percents])
    return df.sparkSession.createDataFrame(
        list(zip(percents, values)), "percentile INT, abs_error DOUBLE"
    )


def error_bins(df: DataFrame, actual: str = "label", predicted: str = "prediction") -> DataFrame:
    """(bin, label, count, percent): histogram of absolute errors; empty bins stay."""
    e = F.abs(F.col(actual) - F.col(predicted))
    counts = df.agg(
        F.count(e).alias("n"),
        *[F.count_if((e >= low) & (e < F.lit(high))).alias(f"b{i}") for i, _, low, high in fixed.ERROR_BINS],
    )
    bins = F.array(*[
        F.struct(
            F.lit(i).alias("bin"), F.lit(label).alias("label"), F.col(f"b{i}").alias("count"),
            F.try_divide(F.col(f"b{i}") * 100.0, F.col("n")).alias("percent"),
        )
        for i, label, _, _ in fixed.ERROR_BINS
    ])
    return counts.select(F.inline(bins))


def best_and_worst(
    df: DataFrame, row_id: str, actual: str = "label", predicted: str = "prediction", n: int = 5,
) -> DataFrame:
    """(kind, rank, row, actual, predicted, abs_error): n smallest and n largest errors."""
    rows = absolute_errors(df, actual, predicted).select(
        F.col(row_id).alias("row"), F.col(actual).alias("actual"), F.col(predicted).alias("predicted"), "abs_error"
    )
    out = []
    for kind, order in (("best", F.asc("abs_error")), ("worst", F.desc("abs_error"))):
        top = rows.orderBy(order, "row").limit(n)
        out.append(top.select(
            F.lit(kind).alias("kind"), F.row_number().over(Window.orderBy(order, "row")).alias("rank"), "*"
        ))
    return out[0].unionByName(out[1])


def fold_summary(scores: DataFrame, by: Sequence[str] = ("approach",)) -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return scores.groupBy(*by).agg(*[
        f(m).alias(f"{m}_{name}")
        for m in ("r2", "rmse", "mae") for name, f in (("mean", F.avg), ("std", F.stddev_pop))
    ])


def train_test_difference(scores: DataFrame, by: str = "name") -> DataFrame:
    """Long (name, dataset, r2, rmse, mae) to one row per name with train - test differences."""
    wide = scores.groupBy(by).pivot("dataset", ["train", "test"]).agg(
        *[F.first(m).alias(m) for m in ("r2", "rmse", "mae")]
    )
    return wide.select(
        "*", *[(F.col(f"train_{m}") - F.col(f"test_{m}")).alias(f"{m}_difference") for m in ("r2", "rmse", "mae")]
    )
