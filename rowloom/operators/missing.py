"""Dropping, flagging and filling missing values."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fixed
from ..functions.cells import is_missing, number
from . import order_stats, profile


class _FillParams(Params):
    rowId = Param(Params._dummy(), "rowId", "row order", TypeConverters.toString)
    byMode = Param(Params._dummy(), "byMode", "columns filled by mode", TypeConverters.toListString)
    byMedian = Param(Params._dummy(), "byMedian", "columns filled by median", TypeConverters.toListString)
    byConstant = Param(Params._dummy(), "byConstant", "columns filled by a constant", TypeConverters.toListString)
    redundant = Param(Params._dummy(), "redundant", "columns always dropped", TypeConverters.toListString)


class MissingValues(Estimator, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns which columns to drop, flag and fill, and with what."""

    def __init__(
        self, rowId: str = "row_id",
        byMode: Sequence[str] = fixed.MODE_COLUMNS,
        byMedian: Sequence[str] = fixed.MEDIAN_COLUMNS,
        byConstant: Sequence[str] = fixed.CONSTANT_COLUMNS,
        redundant: Sequence[str] = fixed.REDUNDANT_TARGETS,
    ):
        super().__init__()
        self._set(
            rowId=rowId, byMode=list(byMode), byMedian=list(byMedian),
            byConstant=list(byConstant), redundant=list(redundant),
        )

    def _fit(self, dataset: DataFrame) -> MissingValuesModel:
        row_id, redundant = self.getOrDefault("rowId"), self.getOrDefault("redundant")
        columns = [c for c in dataset.columns if c != row_id]
        found = profile.missing_profile(dataset, columns).withColumn("tier", profile.tier("percent")).collect()
        tiers = {r["column"]: r["tier"] for r in found}
        dropped = [c for c in columns if tiers.get(c) == "drop" or c in redundant]
        filled = [c for c in columns if c in tiers and c not in dropped]
        indicators = [c for c in filled if tiers[c] == "impute_indicator"]

        fills: dict[str, object] = {}
        by_mode = [c for c in self.getOrDefault("byMode") if c in filled]
        if by_mode:
            fills |= {r["column"]: r["mode"] for r in profile.modes(dataset, by_mode, row_id).collect()}
        by_median = [c for c in self.getOrDefault("byMedian") if c in filled]
        if by_median:
            numbers = dataset.select(*[number(dataset, c).alias(c) for c in by_median])
            fills |= {c: v for c, v in order_stats.medians(numbers, by_median).items() if v is not None}
        fills |= {c: fixed.CONSTANT_FILL for c in self.getOrDefault("byConstant") if c in filled}
        return MissingValuesModel(dropped, indicators, fills)


class MissingValuesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Applies learned drops, indicators and fills: one narrow projection."""

    dropped = Param(Params._dummy(), "dropped", "columns to drop", TypeConverters.toListString)
    indicators = Param(Params._dummy(), "indicators", "columns to flag", TypeConverters.toListString)
    fills = Param(Params._dummy(), "fills", "JSON of column to value", TypeConverters.toString)

    def __init__(self, dropped=(), indicators=(), fills=None):
        super().__init__()
        self._set(dropped=list(dropped), indicators=list(indicators), fills=json.dumps(fills or {}))

    @property
    def values(self) -> dict[str, object]:
        return json.loads(self.getOrDefault("fills"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dropped, fills = set(self.getOrDefault("dropped")), self.values
        kept = []
        for c in dataset.columns:
            if c in dropped:
                continue
            if c not in fills:
                kept.append(F.col(c))
                continue
            kind = dataset.schema[c].dataType
            if isinstance(kind, T.StringType):
                filled, value = F.col(c), F.lit(str(fills[c]))
            elif isinstance(fills[c], str):
                filled, value = F.col(c), F.lit(fills[c]).cast(kind)
            else:
                filled, value = F.col(c).cast("double"), F.lit(float(fills[c]))
            kept.append(F.when(is_missing(dataset, c), value).otherwise(filled).alias(c))
        flags = [
            F.when(is_missing(dataset, c), 1).otherwise(0).alias(f"{c}_missing")
            for c in self.getOrDefault("indicators")
        ]
        return dataset.select(*kept, *flags)

    def filled_counts(self, dataset: DataFrame) -> DataFrame:
        """(column, filled): values this model fills in a table, most first."""
        counts = profile.missing_profile(dataset, list(self.values))
        return counts.select("column", F.col("missing").alias("filled")).orderBy(F.desc("filled"), "column")


def indicator_sums(df: DataFrame) -> DataFrame:
    """(column, missing, percent) of every ``*_missing`` column."""
    flags = [c for c in df.columns if c.endswith("_missing")]
    sums = df.agg(
        *[F.sum(c).alias(f"missing__{i}") for i, c in enumerate(flags)],
        *[(F.avg(c) * 100.0).alias(f"percent__{i}") for i, c in enumerate(flags)],
    )
    return profile._per_column(sums, flags, {"missing": "bigint", "percent": "double"})


def still_missing(df: DataFrame, columns: Sequence[str] | None = None, first: int = 5) -> DataFrame:
    """The columns with most missing values after filling."""
    return profile.missing_profile(df, columns).orderBy(F.desc("missing"), "column").limit(first)
