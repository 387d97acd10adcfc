"""Reading single cells: missing values, whitespace, text that may hold a number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode white space, as removed from both ends of a cell.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0       "
    "         　"
)

# The same characters inside a regular expression: \s and \S of Java and RE2 know the ASCII ones only.
_BLANKS = "".join(f"\\x{{{ord(c):x}}}" for c in dict.fromkeys(WHITE_SPACE))
BLANK, NOT_BLANK = f"[{_BLANKS}]", f"[^{_BLANKS}]"

# The same again for patterns that start with JAVA_FLAG: Java looks up the kind of a character there, instead of
# asking for one listed character after the other at every place of a text.
JAVA_FLAG, JAVA_BLANKS = "(?U)", r"\s\x{1c}-\x{1f}"

# Text accepted as a number. Spark's own cast also takes "1d" and "2f" and rejects "1_000".
_DIGITS = r"[0-9]+(?:_[0-9]+)*"
NUMBER_PATTERN = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity|nan))$"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space at both ends."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def missing_text(c: Column | str) -> Column:
    """True for null and for the empty string; blanks and the text ``nan`` are values."""
    return col(c).isNull() | (col(c) == "")


def is_missing(df: DataFrame, name: str) -> Column:
    """The missing test that fits the column's type."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return missing_text(name)
    return F.col(name).isNull()


def to_double(c: Column | str) -> Column:
    """Parse text as a double; null when it is not a number."""
    text = strip(c)
    return F.when(
        text.rlike(NUMBER_PATTERN),
        F.replace(text, F.lit("_"), F.lit("")).try_cast("double"),
    )


def to_double_or_zero(c: Column | str) -> Column:
    """Parse text as a double; 0.0 when it is missing or not a number."""
    return F.coalesce(to_double(c), F.lit(0.0))


def number(df: DataFrame, name: str) -> Column:
    """A column as a double: parsed when it is text, cast when it is typed."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return to_double(name)
    return F.col(name).cast("double")


def number_or_zero(df: DataFrame, name: str) -> Column:
    return F.coalesce(number(df, name), F.lit(0.0))


def positive_number(c: Column) -> Column:
    """Keep-test for a numeric target: present and not <= 0 (NaN is kept)."""
    return c.isNotNull() & ~(c <= 0)


def blank_to(c: Column | str, value: str) -> Column:
    """Strip, then replace null or blank by ``value``."""
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(value))


def prefix(c: Column | str, n: int) -> Column:
    return F.substring(col(c), 1, n)


def fixed_point(c: Column | str, digits: int) -> Column:
    """Text with a fixed number of decimals, for CSV export only."""
    return F.format_string(f"%.{digits}f", col(c))
