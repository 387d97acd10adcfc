"""Shared inputs of the queries, and SQL fragments of their counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import NOT_BLANK
from ..sources.tables import read_table, spread

# --- SQL fragments ----------------------------------------------------------


def sql_clean(e: str) -> str:
    """Text cleaning, step by step."""
    # The technical terms and the patterns.
    for term, spelled in (("c++", "cplusplus"), ("c#", "csharp"), (".net", "dotnet"), ("node.js", "nodejs")):
        e = f"replace({'lower(' + e + ')' if term == 'c++' else e}, '{term}', '{spelled}')"
    for pattern, by in (
        (rf"http{NOT_BLANK}+|www\.{NOT_BLANK}+", ""), (f"{NOT_BLANK}+@{NOT_BLANK}+", ""), (r"[^a-z0-9\s]", " "), (r"\s+", " "),
    ):
        e = f"regexp_replace({e}, '{pattern}', '{by}', 'g')"
    return f"trim({e})"


def sql_words(cleaned: str, shortest: int = 1) -> str:
    return f"list_filter(string_split({cleaned}, ' '), lambda w: length(w) >= {shortest})"


def sql_grams(tokens: str) -> str:
    """Unigrams and bigrams of a token list column."""
    return (
        f"list_concat({tokens}, list_transform(range(1, len({tokens})), "
        f"lambda i: {tokens}[i] || ' ' || {tokens}[i + 1]))"
    )


def sql_number(e: str) -> str:
    """Guarded parsing of text as a number."""
    d = "[0-9]+(?:_[0-9]+)*"
    pattern = rf"[+-]?(?:(?:{d}(?:\.(?:{d})?)?|\.{d})(?:[eE][+-]?{d})?|(?i:inf|infinity|nan))"
    return (
        f"CASE WHEN regexp_full_match(trim({e}), '{pattern}') "
        f"THEN TRY_CAST(replace(trim({e}), '_', '') AS DOUBLE) END"
    )


def sql_hash(key: str, digits: int = 8) -> str:
    return f"CAST('0x' || substr(md5('42:' || {key}), 1, {digits}) AS BIGINT)"


# --- inputs -----------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name)


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Documents, spread over all cores: their text is what costs time, not their number."""
    return spread(table(spark, folder, "documents").select("doc_id", *columns))


def priced_items(spark: SparkSession, folder: str, busy: bool = False) -> DataFrame:
    """Line items with their part: the regression table. ``busy`` spreads it for costly steps."""
    items = table(spark, folder, "lineitem")
    items = spread(items) if busy else items
    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_size")
    return items.join(parts, items["l_partkey"] == parts["p_partkey"])


def predicted_items(spark: SparkSession, folder: str) -> DataFrame:
    """A closed-form prediction of the price of every line item."""
    return priced_items(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"),
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("prediction"),
    )


SQL_PREDICTED = """
SELECT l_orderkey, l_linenumber, l_returnflag, l_orderkey * 10 + l_linenumber AS row_,
       l_extendedprice AS y, l_quantity * p_retailprice AS p
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


def order_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer, nation and region."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
        .join(nations, customers["c_nationkey"] == nations["n_nationkey"], "left")
        .join(regions, nations["n_regionkey"] == regions["r_regionkey"], "left")
    )


SQL_ORDER_FACTS = """
SELECT * FROM orders
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""
