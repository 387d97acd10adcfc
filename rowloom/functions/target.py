"""The regression target and its parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .cells import col, missing_text, to_double


def _bounds(low, high, median) -> tuple[Column, Column, Column]:
    zero_is_missing = [F.nullif(to_double(c), F.lit(0.0)) for c in (low, high, median)]
    low, high, median = zero_is_missing
    return low, high, F.when(~(median < fixed.SMALLEST_MEDIAN), median)


def normalized_target(low: Column | str, high: Column | str, median: Column | str) -> Column:
    """One yearly amount from textual minimum, maximum and median; null when none is usable."""
    low, high, median = _bounds(low, high, median)
    value = F.coalesce(
        (low + high) / 2.0,
        median,
        low * fixed.MIN_ONLY_FACTOR,
        high * fixed.MAX_ONLY_FACTOR,
    )
    return F.round(F.nullif(value, F.lit(0.0)), 2)


def target_source(low: Column | str, high: Column | str, median: Column | str) -> Column:
    """Which bounds were *present* (a present 0 or a present non-number counts here)."""
    has_low, has_high = ~missing_text(low), ~missing_text(high)
    median_value = F.nanvl(to_double(median), F.lit(None).cast("double"))
    has_median = F.coalesce(median_value >= fixed.SMALLEST_MEDIAN, F.lit(False))
    usable = normalized_target(low, high, median).isNotNull()
    return (
        F.when(~usable, "invalid")
        .when(has_low & has_high, "min_max")
        .when(has_median, "median")
        .when(has_low, "min_only")
        .when(has_high, "max_only")
    )


def yearly_amount(amount: Column | str, period: Column | str) -> Column:
    """Pay per year from pay per period; null for an unknown period."""
    scale = F.create_map(*[F.lit(x) for pair in fixed.PERIODS_PER_YEAR.items() for x in pair])
    return col(amount) * F.try_element_at(scale, F.upper(col(period)))


def plausible_pay(df: DataFrame, amount: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """Drop amounts outside the plausible range and rows whose minimum exceeds the maximum."""
    kept = df.filter(F.col(amount).between(fixed.OUTLIER_LOW, fixed.OUTLIER_HIGH))
    if low and high:
        kept = kept.filter(F.coalesce(F.col(low) <= F.col(high), F.lit(True)))
    return kept
