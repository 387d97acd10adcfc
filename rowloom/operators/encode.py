"""Encoding categorical columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import encoders as E
from ..functions.sparse import sparse_vector
from ..sources.session import materialize
from . import project
from .lookup import lookup_join, row_bytes
from .numbering import ranked


def frequency_table(df: DataFrame, value: Column) -> DataFrame:
    """(value, count): counted with map-side combination, so a dominant value is no hot spot."""
    return df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("count"))


def category_counts(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """(column, value, count) of several categoricals from one scan, written once for reuse."""
    named = df.select(*[value.alias(name) for name, value in values.items()])
    counts = named.unpivot([], list(values), "column", "value").groupBy("column", "value")
    return materialize(counts.agg(F.count(F.lit(1)).alias("count")), "categories")


def frequency_encode(
    df: DataFrame, value: Column, output: str, fit_on: DataFrame | None = None, counts: DataFrame | None = None,
) -> DataFrame:
    """Add ln(count+1)/ln(total+1) of each row's value; 0 for a value not seen when fitting.

    ``counts`` (value, count) may come from an earlier fit.
    """
    if counts is None:
        counts = category_counts(df if fit_on is None else fit_on, {output: value}).select("value", "count")
    fitted = counts.agg(F.sum("count").alias("n"), F.sum(row_bytes(counts)).alias("bytes")).first()
    codes = counts.select(
        F.col("value").alias("__value"), E.log_share(F.col("count"), F.lit(fitted["n"] or 0)).alias(output)
    )
    joined = lookup_join(df.withColumn("__value", value), codes, "__value", "left", size=fitted["bytes"] or 0)
    return joined.withColumn(output, F.coalesce(output, F.lit(0.0))).drop("__value")


def one_hot_long(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, feature, value 1): the non-zero one-hot cells, without any fitting."""
    name = E.one_hot_name_column(column, E.category(column))
    return df.select(key, name.alias("feature"), F.lit(1.0).alias("value"))


def categories(df: DataFrame, column: str) -> list[str]:
    """Sorted categories of a column, each of which becomes a column; ``one_hot_long`` needs no such list."""
    return sorted(r[0] for r in df.select(E.category(column)).distinct().toLocalIterator())


def one_hot_columns(df: DataFrame, column: str, known: Sequence[str] | None = None) -> list[Column]:
    """One 0/1 column per category; a category not among ``known`` gives all zeros."""
    known = categories(df, column) if known is None else known
    value = E.category(column)
    return [F.when(value == c, 1).otherwise(0).alias(E.one_hot_name(column, c)) for c in known]


def one_hot_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, position): a dense number for every category of every column, by column order and category.

    Categories are counted map-side, sorted by ranges and numbered by prefix counts; no list of them is
    anywhere, so a column may have millions.
    """
    counts = category_counts(df, {c: E.category(c) for c in columns})
    order = F.array_position(F.lit(list(columns)), F.col("column"))
    numbered = ranked(counts.select("column", "value"), F.lit(0), [order.asc(), F.col("value").asc()])
    return materialize(numbered.select("column", "value", F.col("rank").cast("int").alias("position")), "one-hot")


def one_hot_vector(
    df: DataFrame, key: str, columns: Sequence[str], output: str = "one_hot", numbers: DataFrame | None = None,
) -> tuple[DataFrame, int]:
    """(key, sparse vector of all columns' one-hot cells), and its length; ``key`` is unique.

    ``numbers`` may come from an earlier fit; a category that it lacks has no entry.
    """
    numbers = one_hot_numbers(df, columns) if numbers is None else numbers
    fitted = numbers.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(numbers)).alias("bytes")).first()
    held = df.select(key, *[E.category(c).alias(c) for c in columns]).unpivot([key], list(columns), "column", "value")
    # One text of both, so that a hot category meets a broadcast slice where the numbers are too many to send.
    both = F.concat_ws("\x00", "column", "value")
    codes = numbers.select(both.alias("__cell"), "position")
    cells = lookup_join(held.select(key, both.alias("__cell")), codes, "__cell", "left", size=fitted["bytes"] or 0)
    places = F.array_sort(F.array_compact(F.collect_list("position")))
    rows = cells.groupBy(key).agg(places.alias("__places"))
    ones = F.transform("__places", lambda _: F.lit(1.0))
    return rows.withColumn("__ones", ones).select(key, sparse_vector(fitted["n"], "__places", "__ones").alias(output)), fitted["n"]


def encode_stage(df: DataFrame) -> DataFrame:
    """All encodings of the model table; raw categoricals and texts are dropped.

    One scan counts the categories of all one-hot and frequency columns.
    """
    present = set(df.columns)
    hot = {c: E.category(c) for c in fixed.ONE_HOT_COLUMNS if c in present}
    frequent = {
        c: E.state_code(c) if c == "state" else E.category(c) for c in fixed.FREQUENCY_COLUMNS if c in present
    }
    counts = category_counts(df, hot | frequent) if hot or frequent else None
    added = [
        E.ordinal_code(c, scale).alias(f"{c}_ordinal") for c, scale in fixed.ORDINAL_COLUMNS.items() if c in present
    ]
    for c in hot:
        known = sorted(r[0] for r in counts.filter(F.col("column") == c).select("value").toLocalIterator())
        added += one_hot_columns(df, c, known)
    out = df
    for c, value in frequent.items():
        fitted = counts.filter(F.col("column") == c).select("value", "count")
        out = frequency_encode(out, value, f"{c}_frequency", counts=fitted)
        added.append(F.col(f"{c}_frequency"))
    added += [
        E.equals_flag(c, value).alias(f"{c}_binary") for c, value in fixed.BINARY_COLUMNS.items() if c in present
    ]
    return out.select(*project.encoded_columns(df.columns), *added)
