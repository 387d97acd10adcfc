"""Row and column selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import target as target_functions
from ..functions.cells import is_missing, number, positive_number
from . import order_stats


def add_target(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    """Add the normalised target computed from the three bounds."""
    return df.withColumn(target, target_functions.normalized_target(*fixed.TARGET_BOUNDS))


def keep_columns(
    columns: Sequence[str], dropped: Iterable[str] = fixed.NON_ESSENTIAL,
    target: str = fixed.TARGET, after: str = "salary_yearly_med",
) -> list[str]:
    """Columns left after a drop list, with the target after a given column or else last."""
    dropped = set(dropped)
    kept = [c for c in columns if c not in dropped]
    if target not in kept:
        kept.insert(kept.index(after) + 1 if after in kept else len(kept), target)
    return kept


def final_table(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    """Rows with a target, without the non-essential columns."""
    original = df.columns
    return with_value(add_target(df, target), target).select(*keep_columns(original, target=target))


def with_value(df: DataFrame, column: str) -> DataFrame:
    """Rows where a column is not missing."""
    return df.filter(~is_missing(df, column))


def with_positive_target(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    """Rows whose target is a number above zero."""
    return df.filter(positive_number(number(df, target)))


def enough_rows(df: DataFrame, least: int = fixed.SMALLEST_SAMPLE) -> bool:
    """Whether a table has at least ``least`` rows; reads no more than that."""
    return df.limit(least).count() >= least


def row_at(df: DataFrame, row_id: str, k: int) -> DataFrame:
    """The row at 0-based position k of the row order."""
    found = order_stats.value_at(df, row_id, k)
    if k < 0 or found is None:
        raise IndexError(f"row {k} is out of range")
    return df.filter(F.col(row_id) == found)


def first_rows(df: DataFrame, row_id: str, n: int) -> DataFrame:
    """The first n rows (fewer when the table is shorter)."""
    return df.orderBy(row_id).limit(n)


def encoded_columns(columns: Sequence[str]) -> list[str]:
    """Columns kept once categoricals are encoded and texts are features."""
    gone = {
        *fixed.ORDINAL_COLUMNS, *fixed.ONE_HOT_COLUMNS, *fixed.FREQUENCY_COLUMNS, *fixed.BINARY_COLUMNS,
        *fixed.DROPPED_AFTER_ENCODING, *fixed.TEXT_DROPPED_AFTER_ENCODING,
    } - set(fixed.KEPT_AFTER_ENCODING)
    return [c for c in columns if c not in gone]


def union_names(*lists: Iterable[str]) -> list[str]:
    """Different names of several lists, in first-seen order."""
    return list(dict.fromkeys(name for names in lists for name in names))
