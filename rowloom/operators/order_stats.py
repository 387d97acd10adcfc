"""Exact order statistics without sorting the table or holding it in one place.

``F.percentile``/``F.median`` keep every distinct value of a group in one buffer, and a global
``row_number`` or ``ntile`` puts all rows through one task. Here a mergeable sketch brackets each
wanted rank, a counting scan makes the bracket exact, and only brackets of at most ``limit``
values together are ever gathered. Every pass is a scan with partial aggregation and no row shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 1_000_000
_ACCURACY = 10_000


@dataclass
class _Bracket:
    column: str
    rank: int
    inside: int
    below: int = 0
    low: object = None
    high: object = None
    value: object = None
    done: bool = False

    def test(self) -> Column:
        """Rows strictly between the two ends (nulls never qualify)."""
        c = F.col(self.column)
        test = c.isNotNull()
        if self.low is not None:
            test = test & (c > F.lit(self.low))
        if self.high is not None:
            test = test & (c < F.lit(self.high))
        return test

    def settle(self, value) -> None:
        self.value, self.done = value, True


def order_statistics(
    df: DataFrame,
    wanted: Mapping[str, Callable[[int], Sequence[int]]],
    limit: int = LIMIT,
) -> tuple[dict[str, int], dict[tuple[str, int], object]]:
    """Values at 0-based ranks of numeric columns, nulls left out.

    ``wanted`` maps a column to a function from its number of values to the ranks wanted.
    Returns the number of values per column and the value per (column, rank).
    """
    columns = list(wanted)
    df = df.select(*columns)
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    brackets = [
        _Bracket(c, rank, counts[c])
        for c in columns
        for rank in sorted(set(wanted[c](counts[c])))
        if 0 <= rank < counts[c]
    ]
    while open_ := _too_wide([b for b in brackets if not b.done], limit):
        _narrow(df, open_)
    _gather(df, [b for b in brackets if not b.done])
    return counts, {(b.column, b.rank): b.value for b in brackets}


def _too_wide(brackets: list[_Bracket], limit: int) -> list[_Bracket]:
    """Brackets to shrink further, so that all spans together hold at most ``limit`` values."""
    spans = {(b.column, b.low, b.high) for b in brackets}
    return [b for b in brackets if b.inside * len(spans) > limit and b.inside > 1]


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Shrink each bracket to a few thousandths of its rows."""
    spans: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        spans.setdefault((b.column, b.low, b.high), []).append(b)
    groups = list(spans.values())
    # One sketch per span answers all the ranks wanted from it.
    sketches, bases = [], []
    for i, g in enumerate(groups):
        shares = [(b.rank - b.below + 0.5) / b.inside for b in g]
        around = [min(max(s + d, 0.0), 1.0) for s in shares for d in (-3 / _ACCURACY, 3 / _ACCURACY)]
        # Sketches work in doubles, which cannot tell large neighbouring integers apart: whole numbers are
        # sketched by their distance from the bracket's end.
        whole = df.schema[g[0].column].dataType.typeName() in ("byte", "short", "integer", "long")
        bases.append(g[0].low if whole and g[0].low is not None else 0)
        value = F.try_subtract(F.col(g[0].column).cast("long"), F.lit(bases[-1]).cast("long")) if whole else F.col(g[0].column)
        values = F.when(g[0].test(), value)
        sketches.append(F.percentile_approx(values, around, _ACCURACY).alias(f"s{i}"))
    row = df.agg(*sketches).first()
    found = {
        id(b): [v + bases[i] if bases[i] else v for v in row[f"s{i}"][2 * j:2 * j + 2]]
        for i, g in enumerate(groups) for j, b in enumerate(g)
    }
    counters = []
    for i, b in enumerate(brackets):
        c, (low, high) = F.col(b.column), found[id(b)]
        parts = {
            "lt": c < F.lit(low), "lo": c == F.lit(low),
            "in": (c > F.lit(low)) & (c < F.lit(high)), "hi": c == F.lit(high),
        }
        counters += [F.count_if(b.test() & test).alias(f"{name}{i}") for name, test in parts.items()]
    counted = df.agg(*counters).first()
    for i, b in enumerate(brackets):
        low, high = found[id(b)]
        before = b.inside, b.low, b.high
        at = b.rank - b.below
        less, equal_low, between = counted[f"lt{i}"], counted[f"lo{i}"], counted[f"in{i}"]
        equal_high = counted[f"hi{i}"] if high != low else 0
        if at < less:
            b.high, b.inside = low, less
        elif at < less + equal_low:
            b.settle(low)
        elif at < less + equal_low + between:
            b.below, b.low, b.high, b.inside = b.below + less + equal_low, low, high, between
        elif at < less + equal_low + between + equal_high:
            b.settle(high)
        else:
            passed = less + equal_low + between + equal_high
            b.below, b.low, b.inside = b.below + passed, high, b.inside - passed
        if not b.done and before == (b.inside, b.low, b.high):
            raise ArithmeticError(f"the values of {b.column} around rank {b.rank} cannot be told apart")


def _gather(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Read the ranks off the sorted brackets."""
    spans: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        spans.setdefault((b.column, b.low, b.high), []).append(b)
    if not spans:
        return
    groups = list(spans.values())
    lists = df.agg(*[
        F.collect_list(F.when(g[0].test(), F.col(g[0].column))).alias(f"v{i}") for i, g in enumerate(groups)
    ])
    lists = lists.select(*[F.sort_array(f"v{i}").alias(f"v{i}") for i in range(len(groups))])
    picked = lists.select(*[
        F.array(*[F.col(f"v{i}")[b.rank - b.below] for b in g]).alias(f"p{i}") for i, g in enumerate(groups)
    ]).first()
    for i, g in enumerate(groups):
        for b, value in zip(g, picked[f"p{i}"]):
            b.settle(value)


def percentiles(df: DataFrame, column: str, shares: Sequence[float], limit: int = LIMIT) -> list[float | None]:
    """Percentiles with linear interpolation between neighbouring values."""
    def ranks(n: int) -> list[int]:
        exact = [(n - 1) * s for s in shares]
        return [r for e in exact for r in (math.floor(e), math.ceil(e))] if n else []

    counts, values = order_statistics(df, {column: ranks}, limit)
    n = counts[column]
    if not n:
        return [None] * len(shares)
    out = []
    for s in shares:
        exact = (n - 1) * s
        low, high = values[column, math.floor(exact)], values[column, math.ceil(exact)]
        out.append(float(low + (high - low) * (exact - math.floor(exact))))
    return out


def medians(df: DataFrame, columns: Sequence[str], limit: int = LIMIT) -> dict[str, float | None]:
    """Median of each column (mean of the two middle values), nulls left out."""
    if not columns:
        return {}
    middle = {c: (lambda n: [(n - 1) // 2, n // 2] if n else []) for c in columns}
    counts, values = order_statistics(df, middle, limit)
    return {
        c: (values[c, (n - 1) // 2] + values[c, n // 2]) / 2 if (n := counts[c]) else None
        for c in columns
    }


def index_quartiles(df: DataFrame, column: str, limit: int = LIMIT) -> dict[str, object]:
    """The values at positions n//4, n//2 and 3n//4 of the sorted column."""
    places = {"p25": lambda n: n // 4, "p50": lambda n: n // 2, "p75": lambda n: 3 * n // 4}
    counts, values = order_statistics(df, {column: lambda n: [f(n) for f in places.values()]}, limit)
    return {name: values.get((column, f(counts[column]))) for name, f in places.items()}


def value_at(df: DataFrame, column: str, rank: int, limit: int = LIMIT):
    """The value at a 0-based rank; None when the column is shorter."""
    _, values = order_statistics(df, {column: lambda n: [rank]}, limit)
    return values.get((column, rank))
