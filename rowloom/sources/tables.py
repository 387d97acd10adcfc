"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import csv_ranges
from .session import new_path, new_table

# Options under which text with quotes, separators and line breaks survives a round trip.
_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, row_id: str | None = None) -> DataFrame:
    """CSV with a header; every cell is text and an empty cell is null.

    A quoted cell may hold line breaks; a file is still read by as many tasks as it has byte ranges. With
    ``row_id`` a column of that name numbers the rows in file order, with gaps. What is read twice is the
    text, so land large inputs as Parquet once.
    """
    names = list(columns) if columns is not None else spark.read.options(**_CSV).csv(path).columns
    return csv_ranges.read(spark, path, names, {"quote": '"', "escape": '"', "multiLine": "true"}, row_id)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV with a header and a fixed column order; other columns are left out."""
    out = df.select(*columns) if columns is not None else df
    out.write.options(**_CSV, quoteAll=True, emptyValue="", nullValue=None).csv(path)


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add an increasing id that follows file order, without a shuffle.

    The ids have gaps. Rows of ``read_csv`` that reach over two byte ranges come last; its own ``row_id``
    keeps file order for these as well. Everything here that needs a position (folds, row k, first rows) works
    on order statistics of the id, so no dense numbering is ever built.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


@dataclass(frozen=True)
class FeatureChoice:
    """Which feature groups go into a table."""

    title_terms: bool = True
    description_terms: bool = True
    skills_terms: bool = True
    title_vectors: bool = True
    description_vectors: bool = True

    def blocks(self) -> list[str]:
        return [name for name, used in vars(self).items() if used]

    def table_name(self) -> str:
        with_vectors = self.title_vectors or self.description_vectors
        return "with_nlp_features" if with_vectors else "with_tfidf_only"


def join_blocks(base: DataFrame, blocks: dict[str, DataFrame], choice: FeatureChoice, key: str = "row_id") -> DataFrame:
    """Attach the chosen feature blocks (one row per key each) to the base table."""
    out = base
    for name in choice.blocks():
        if name in blocks:
            out = out.join(blocks[name], key, "inner")
    return out


def store_blocks(spark: SparkSession, tables: dict[str, DataFrame], key: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Write tables bucketed and sorted by their key, and return the written ones.

    Each table is shuffled once, when it is written; joining any choice of them (``join_blocks``) then merges
    bucket with bucket and moves no row. ``buckets`` is the same for all; take as many as the largest table has
    times 128 MB.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = {}
    for name, df in tables.items():
        path = new_path(spark, f"block-{name}")
        table = new_table(path)
        # One file per bucket: a table read with several would be sorted again.
        dealt = df.repartition(buckets, key)
        dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
        stored[name] = spark.table(table).hint("merge")
    return stored


def spread(df: DataFrame) -> DataFrame:
    """Redistribute the rows of a plain scan that yields fewer tasks than there are cores.

    For scans and narrow steps only: counting the tasks of a plan with a shuffle would run it.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
