"""Row rules, the reject table and type inference from first values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.cells import NUMBER_PATTERN, missing_text, strip, to_double

REASONS = "validation_reasons"


def reasons(rules: Mapping[str, Mapping] = fixed.CRITICAL_FIELDS) -> Column:
    """Array of everything wrong with a row; empty when it passes."""
    found = []
    for field, rule in rules.items():
        value = strip(F.coalesce(F.col(field).cast("string"), F.lit("")))
        absent = (value == "") if rule.get("required") else F.lit(False)
        found.append(F.when(absent, F.lit(f"{field}: MISSING or EMPTY")))
        if "min_length" in rule:
            least = rule["min_length"]
            found.append(F.when(
                ~absent & (F.length(value) < least),
                F.concat(F.lit(f"{field}: Too short ("), F.length(value), F.lit(f" chars, min {least})")),
            ))
        if "min_value" in rule or "max_value" in rule:
            amount = to_double(value)
            shown = F.concat(F.lit(f"{field}: $"), F.format_number(amount, 0))
            comparable = ~absent & ~F.isnan(amount)
            if "min_value" in rule:
                low = rule["min_value"]
                found.append(F.when(comparable & (amount < low), F.concat(shown, F.lit(f" < min ${low:,}"))))
            if "max_value" in rule:
                high = rule["max_value"]
                found.append(F.when(comparable & (amount > high), F.concat(shown, F.lit(f" > max ${high:,}"))))
            found.append(F.when(~absent & amount.isNull(), F.lit(f"{field}: Not a valid number")))
    return F.array_compact(F.array(*found))


def with_reasons(df: DataFrame, rules: Mapping[str, Mapping] = fixed.CRITICAL_FIELDS) -> DataFrame:
    return df.withColumn(REASONS, reasons(rules))


def valid_rows(df: DataFrame, rules: Mapping[str, Mapping] = fixed.CRITICAL_FIELDS) -> DataFrame:
    return with_reasons(df, rules).filter(F.size(REASONS) == 0).drop(REASONS)


def rejected_rows(df: DataFrame, rules: Mapping[str, Mapping] = fixed.CRITICAL_FIELDS) -> DataFrame:
    """Rows that fail, with all reasons in ``validation_errors``."""
    bad = with_reasons(df, rules).filter(F.size(REASONS) > 0)
    return bad.withColumn("validation_errors", F.array_join(REASONS, " | ")).drop(REASONS)


def report(df: DataFrame, rules: Mapping[str, Mapping] = fixed.CRITICAL_FIELDS) -> DataFrame:
    """(rows, invalid, invalid_percent)."""
    checked = df.select((F.size(reasons(rules)) > 0).alias("bad"))
    return checked.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("bad").alias("invalid"),
        F.try_divide(F.count_if("bad") * 100.0, F.count(F.lit(1))).alias("invalid_percent"),
    )


def reason_counts(df: DataFrame, rules: Mapping[str, Mapping] = fixed.CRITICAL_FIELDS) -> DataFrame:
    """(field, count): how often each field fails."""
    each = df.select(F.explode_outer(reasons(rules)).alias("reason")).filter(F.col("reason").isNotNull())
    return each.groupBy(F.substring_index("reason", ":", 1).alias("field")).agg(F.count(F.lit(1)).alias("count"))


def first_values(
    df: DataFrame, row_id: str, excluded: Iterable[str] = fixed.LEAKAGE, rows: int = fixed.INFERENCE_ROWS,
) -> DataFrame:
    """(column, sample, is_numeric) from the first non-empty value within the first rows.

    A column that is empty in all of them does not appear.
    """
    excluded = {*excluded, row_id}
    columns = [c for c in df.columns if c not in excluded]
    head = df.select(row_id, *[F.col(c).cast("string").alias(c) for c in columns]).orderBy(row_id).limit(rows)
    firsts = head.agg(*[
        F.min_by(c, F.when(~missing_text(c), F.col(row_id))).alias(c) for c in columns
    ])
    long = firsts.unpivot([], columns, "column", "sample").filter(~missing_text("sample"))
    return long.withColumn("is_numeric", strip("sample").rlike(NUMBER_PATTERN))


def numeric_columns(df: DataFrame, row_id: str, excluded: Iterable[str] = fixed.LEAKAGE) -> list[str]:
    """Names of the numeric columns, in table order."""
    numeric = {r["column"] for r in first_values(df, row_id, excluded).filter("is_numeric").collect()}
    return [c for c in df.columns if c in numeric]


def numeric_table(df: DataFrame, row_id: str, target: str = fixed.TARGET) -> DataFrame:
    """The numeric columns and the target."""
    return df.select(row_id, *numeric_columns(df, row_id), target)
