"""Train/test splits and folds that do not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from . import order_stats


def row_hash(key: Column | str, seed: int = fixed.SEED, digits: int = 8) -> Column:
    """A number from the first hex digits of md5("seed:key")."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def in_test(key: Column | str, share: float = fixed.TEST_SHARE, seed: int = fixed.SEED) -> Column:
    """True for about ``share`` of the rows; a narrow expression."""
    return row_hash(key, seed) % 10_000 < round(share * 10_000)


def hash_split(df: DataFrame, key: str, share: float = fixed.TEST_SHARE, seed: int = fixed.SEED):
    """(train, test) by row hash."""
    return df.filter(~in_test(key, share, seed)), df.filter(in_test(key, share, seed))


def exact_split(df: DataFrame, key: str, share: float = fixed.TEST_SHARE, seed: int = fixed.SEED) -> DataFrame:
    """Add ``is_test`` for exactly ceil(share * n) rows: those with the smallest hashes.

    The threshold is an order statistic; rows with the very threshold hash go by key order.
    """
    code = row_hash(key, seed, 15)
    coded = df.select(key, code.alias("code"))
    counts, found = order_stats.order_statistics(
        coded, {"code": lambda n: [math.ceil(share * n) - 1] if n else []}
    )
    wanted = math.ceil(share * counts["code"])
    if not wanted:
        return df.withColumn("is_test", F.lit(False))
    threshold = found["code", wanted - 1]
    before = coded.filter(F.col("code") < threshold).count()
    last = order_stats.value_at(coded.filter(F.col("code") == threshold), key, wanted - before - 1)
    return df.withColumn("is_test", (code < threshold) | ((code == threshold) & (F.col(key) <= F.lit(last))))


def fold_starts(df: DataFrame, row_id: str, k: int = fixed.FOLDS) -> list:
    """First row id of folds 2..k when rows are cut, in row order, into k near-equal runs."""
    def starts(n: int) -> list[int]:
        size, longer = divmod(n, k)
        return [i * size + min(i, longer) for i in range(1, k)]

    counts, values = order_stats.order_statistics(df, {row_id: starts})
    return [values.get((row_id, r)) for r in starts(counts[row_id])]


def with_folds(df: DataFrame, row_id: str, k: int = fixed.FOLDS, name: str = "fold") -> DataFrame:
    """Add the fold number 1..k. Only the k-1 cut points are computed; rows do not move."""
    fold = F.lit(1)
    for start in fold_starts(df, row_id, k):
        if start is not None:
            fold = fold + (F.col(row_id) >= F.lit(start)).cast("int")
    return df.withColumn(name, fold)
