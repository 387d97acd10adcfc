"""Text cleaning, tokens and n-grams as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .cells import JAVA_BLANKS, JAVA_FLAG, col, strip

_BLANK, _NOT_BLANK = f"[{JAVA_BLANKS}]", f"[^{JAVA_BLANKS}]"
# An address is a run of non-blanks with an @ inside of it. Such a run is read once: neither its start nor the @ is
# tried at another place, so the time does not depend on what the text holds.
_EMAIL = f"{JAVA_FLAG}(?<!{_NOT_BLANK}){_NOT_BLANK}[^{JAVA_BLANKS}@]*+@{_NOT_BLANK}++"


def clean_text(c: Column | str) -> Column:
    """Lower-case ASCII words separated by single spaces.

    Technical terms are spelled out first, URLs and e-mail addresses are removed, and every
    other run of characters outside ``a-z0-9`` becomes one space. Null and blank give ``''``.
    """
    text = F.lower(F.coalesce(col(c), F.lit("")))
    for term, spelled in fixed.TECHNICAL_TERMS:
        text = F.replace(text, F.lit(term), F.lit(spelled))
    text = F.regexp_replace(text, JAVA_FLAG + fixed.URL_PATTERN.replace(r"\S", _NOT_BLANK), "")
    text = F.regexp_replace(text, _EMAIL, "")
    return F.trim(F.regexp_replace(text, r"[^a-z0-9]+", " "))


def words(cleaned: Column | str) -> Column:
    """Words of cleaned text; no word gives an empty array."""
    return F.array_remove(F.split(col(cleaned), " "), "")


def raw_words(c: Column | str) -> Column:
    """Words of uncleaned text, split at white space."""
    return F.array_remove(F.split(F.coalesce(col(c), F.lit("")), f"{JAVA_FLAG}{_BLANK}+"), "")


def pipe_items(c: Column | str) -> Column:
    """Items of a pipe-separated list, stripped, blanks dropped."""
    parts = F.split(F.coalesce(col(c), F.lit("")), r"\|")
    return F.filter(F.transform(parts, strip), lambda item: item != "")


def field_words(c: Column | str, field: str, pipe_fields: Iterable[str] = fixed.PIPE_FIELDS) -> Column:
    """Words of a field: pipe lists item by item, prose as a whole."""
    if field in tuple(pipe_fields):
        return F.flatten(F.transform(pipe_items(c), lambda item: words(clean_text(item))))
    return words(clean_text(c))


def long_words(cleaned: Column | str, shortest: int = 2) -> Column:
    """Words of cleaned text with at least ``shortest`` characters."""
    return F.regexp_extract_all(col(cleaned), F.lit(rf"[a-z0-9]{{{shortest},}}"), F.lit(0))


def longer_ngrams(tokens: Column | str, longest: int) -> Column:
    """All n-grams of 2..longest tokens, joined by a space; null where a token is null."""
    tokens, grams = col(tokens), []
    for n in range(2, longest + 1):
        count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        joined = F.slice(tokens, F.lit(1), count)
        for skip in range(1, n):
            joined = F.zip_with(
                joined, F.slice(tokens, F.lit(skip + 1), count),
                lambda left, right: F.concat(left, F.lit(" "), right),
            )
        grams.append(joined)
    return F.concat(*grams)


def ngrams(tokens: Column | str, longest: int) -> Column:
    """All n-grams of 1..longest tokens, joined by a space."""
    return F.concat(col(tokens), longer_ngrams(tokens, longest)) if longest > 1 else col(tokens)


def first_words(cleaned: Column | str, n: int = fixed.DESCRIPTION_WORDS) -> Column:
    """The first n words, joined by single spaces."""
    return F.array_join(F.slice(words(cleaned), 1, n), " ")


def joined_fields(*columns: Column | str) -> Column:
    """Fields joined by one space each, a missing field counting as empty; not cleaned."""
    parts = [F.coalesce(col(c), F.lit("")) for c in columns]
    return F.concat_ws(" ", *parts)
