"""Encoding expressions for categorical cells."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .cells import blank_to, col, strip


def _lookup(table: Mapping, key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def ordinal_code(c: Column | str, scale: Mapping[str, int], default: int = -1) -> Column:
    """Rank on a scale: the exact entry, else the first entry contained in the text."""
    text = strip(F.coalesce(col(c), F.lit("")))
    contained = [F.when(F.contains(text, F.lit(name)), F.lit(rank)) for name, rank in scale.items()]
    return F.coalesce(_lookup(scale, text), *contained, F.lit(default)).cast("int")


def state_code(c: Column | str) -> Column:
    """US state as a two-letter code; other text unchanged; empty or ``0`` as ``missing``."""
    text = strip(F.coalesce(col(c), F.lit("")))
    return (
        F.when((text == "") | (col(c) == "0"), "missing")
        .when(text.rlike(r"^\p{L}{2}$"), F.upper(text))
        .otherwise(F.coalesce(_lookup(fixed.STATE_CODES, text), text))
    )


def category(c: Column | str) -> Column:
    """Category text, blank as ``missing``."""
    return blank_to(c, "missing")


def equals_flag(c: Column | str, value: str) -> Column:
    """1 when the stripped upper-case text is ``value``, else 0 (also for null)."""
    return F.coalesce((F.upper(strip(c)) == value).cast("int"), F.lit(0))


def log_share(count: Column, total: Column) -> Column:
    """ln(count + 1) / ln(total + 1)."""
    return F.log1p(count) / F.log1p(total)


def one_hot_name(field: str, value: str) -> str:
    """Column name of one category."""
    return f"{field}_" + f"{field}_{value}".replace(f"{field}_", "").replace(" ", "_").replace("-", "_")


def one_hot_name_column(field: str, value: Column | str) -> Column:
    """The same name as a column expression."""
    name = F.concat(F.lit(f"{field}_"), col(value))
    short = F.regexp_replace(name, re.escape(f"{field}_"), "")
    return F.concat(F.lit(f"{field}_"), F.translate(short, " -", "__"))
