"""Profiling tables: missing values, completeness, targets, shares, rollups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.cells import is_missing
from . import order_stats


def _per_column(one_row: DataFrame, columns: Sequence[str], fields: Mapping[str, str]) -> DataFrame:
    """Turn one row of ``<field>__<i>`` aggregates into one row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{f}__{i}").cast(t).alias(f) for f, t in fields.items()])
        for i, c in enumerate(columns)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """(column, missing, percent), all columns in one aggregation."""
    columns = list(columns or df.columns)
    counts = df.agg(
        *[F.count_if(is_missing(df, c)).alias(f"missing__{i}") for i, c in enumerate(columns)],
        F.count(F.lit(1)).alias("n"),
    )
    for i in range(len(columns)):
        counts = counts.withColumn(f"percent__{i}", F.try_divide(F.col(f"missing__{i}") * 100.0, F.col("n")))
    out = _per_column(counts, columns, {"missing": "bigint", "percent": "double"})
    return out.filter(F.col("missing") > 0) if only_missing else out


def tier(percent: Column | str) -> Column:
    """What to do with a column, by its percentage of missing values."""
    percent = F.col(percent) if isinstance(percent, str) else percent
    return (
        F.when(percent >= fixed.DROP_AT_PERCENT, "drop")
        .when(percent >= fixed.INDICATOR_AT_PERCENT, "impute_indicator")
        .otherwise("impute")
    )


def completeness(df: DataFrame, roles: Mapping[str, Sequence[str]], distinct_role: str = "categorical") -> DataFrame:
    """(role, column, complete_percent, distinct_values); distinct only for categoricals."""
    pairs = [(role, c) for role, cs in roles.items() for c in cs if c in df.columns]
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, (role, c) in enumerate(pairs):
        present = ~is_missing(df, c)
        aggregates.append(F.count_if(present).alias(f"present__{i}"))
        if role == distinct_role:
            aggregates.append(F.count_distinct(F.when(present, F.col(c))).alias(f"distinct_values__{i}"))
    one_row = df.agg(*aggregates)
    entries = [
        F.struct(
            F.lit(role).alias("role"), F.lit(c).alias("column"),
            F.try_divide(F.col(f"present__{i}") * 100.0, F.col("n")).alias("complete_percent"),
            (F.col(f"distinct_values__{i}") if role == distinct_role else F.lit(None)).cast("bigint").alias("distinct_values"),
        )
        for i, (role, c) in enumerate(pairs)
    ]
    return one_row.select(F.inline(F.array(*entries)))


def modes(df: DataFrame, columns: Sequence[str], row_id: str) -> DataFrame:
    """(column, mode, count, distinct_values): the most frequent value, ties to the first row.

    Values are counted before anything is grouped by column, so a value holding a third of the
    rows costs one partial count per task.
    """
    values = df.select(
        row_id,
        *[F.when(~is_missing(df, c), F.col(c).cast("string")).alias(c) for c in columns],
    ).unpivot([row_id], list(columns), "column", "value").filter(F.col("value").isNotNull())
    counted = values.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("count"), F.min(row_id).alias("first_row")
    )
    order = F.struct("count", -F.col("first_row"))
    return counted.groupBy("column").agg(
        F.max_by("value", order).alias("mode"),
        F.max("count").alias("count"),
        F.count(F.lit(1)).alias("distinct_values"),
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """(value, count, percent of all rows)."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.select("value", "count", (F.col("count") * 100.0 / total).alias("percent"))


def target_stats(df: DataFrame, column: str) -> DataFrame:
    """(n, min, max, mean, median, std): population standard deviation, exact median."""
    median = order_stats.medians(df, [column])[column]
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"),
        F.lit(median).cast("double").alias("median"), F.stddev_pop(c).alias("std"),
    )


def target_summary(df: DataFrame, column: str) -> DataFrame:
    """(n, min, p25, p50, p75, max, mean) with quartiles taken at sorted positions."""
    quartiles = order_stats.index_quartiles(df, column)
    c = F.col(column)
    return df.agg(
        F.count(c).alias("n"), F.min(c).alias("min"),
        *[F.lit(v).cast("double").alias(name) for name, v in quartiles.items()],
        F.max(c).alias("max"), F.avg(c).alias("mean"),
    )


def one_to_many(df: DataFrame, key: str, value: str, position: str, name: str) -> DataFrame:
    """Per key: number of entries, the first one, and all different ones as a pipe list.

    Entries are reduced to different (key, value) pairs first. A key with very many rows is
    thereby split over all tasks, and its list is only as long as the value's domain.
    """
    pairs = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(position).alias("at"))
    return pairs.groupBy(key).agg(
        F.sum("n").alias(f"{name}_count"),
        F.min_by(value, F.struct("at", value)).alias(f"primary_{name}"),
        F.array_join(F.sort_array(F.collect_list(value)), "|").alias(f"all_{name}"),
    )


def merge_dimensions(base: DataFrame, *steps: tuple[DataFrame, str]) -> DataFrame:
    """Left-join dimension tables one after another; Spark broadcasts those it measures as small."""
    for dimension, key in steps:
        base = base.join(dimension, key, "left")
    return base
