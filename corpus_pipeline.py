"""A training corpus from raw documents, in five stages.

Each stage takes what its predecessor kept, as a written table, and returns the columns of documents; the
last one returns the tokens. Columns that a stage adds for itself get names that no column has.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import bpe, cotraining, mixing, ngram_join, toxicity
from rowloom.sources.session import materialize

#: Weights of the sources in the mix, by code point, repeating.
WEIGHTS = (5, 2, 1)


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _numbered(docs: DataFrame, row: str) -> DataFrame:
    """The documents with a number for each row, written, so that a row keeps its number."""
    return materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    model = cotraining.fit(docs, _labels(spark, sf_dir), "quality", F.lit(True))
    score = _fresh(docs, "_quality")
    return cotraining.with_score(docs, model, score).filter(F.col(score) >= 0.5).drop(score)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is one half or more go."""
    model = toxicity.fit(docs, _labels(spark, sf_dir), "toxic", F.lit(True))
    score, spans = _fresh(docs, "_toxic"), _fresh(docs, "_spans")
    return toxicity.with_score(docs, model, score, spans).filter(F.col(score) < 0.5).drop(score, spans)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that with the smallest doc_id, nulls last, ties by a hash of the text.

    Rows without words are nobody's copies and stay.
    """
    row = _fresh(docs, "_row")
    docs = _numbered(docs, row)
    found = ngram_join.near_copies(docs.select(F.col(row).alias("doc_id"), "text")).select(F.col("doc_id").alias("_at"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), F.col(row).alias("_at"))
    keys = docs.select(F.col(row).alias("_of"), order.alias("_order"))
    kept = keys.join(found, keys["_of"] == found["_at"]).groupBy("component_id").agg(F.min("_order").alias("_least")).select("_least._at")
    return docs.join(kept, docs[row] == F.col("_at"), "left_semi").drop(row)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    row, key, copies, turn = (_fresh(docs, name) for name in ("_row", "_key", "_copies", "_turn"))
    docs = _numbered(docs, row)
    drawn = mixing.mix(docs, WEIGHTS, row=row).filter("copies > 0").select(F.col(row).alias(key), F.col("copies").alias(copies))
    taken = docs.join(drawn, docs[row] == F.col(key))
    return taken.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*(docs[c] for c in docs.columns if c != row))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality), ("toxicity", toxic), ("n-gram Jaccard join", near_copies),
    ("mixing to target weights", mix), ("byte-level BPE", tokens),
]

#: Trained classifiers and BPE merges have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
