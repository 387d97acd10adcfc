"""The operators applied to the standard tables, with the SQL counterparts that exist."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, context_tree, cotraining, licence_scan, merkle, mixing, ngram_join, one_bit_codes, periodic_runs, token_files, toxicity, warc, winnowing
from .common import crc_text, table


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.detect(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.withColumn("n_spans", F.size("spans")).drop("spans")


def op3_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    return cotraining.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_one_bit_codes(spark: SparkSession, folder: str) -> DataFrame:
    return one_bit_codes.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_copies(table(spark, folder, "documents"))


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op7_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    return context_tree.score(table(spark, folder, "documents"), crc_text(F.col("doc_id")) % 7 != 2)


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op9_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.compare(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("copies")


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(table(spark, folder, "documents"), merkle.third(F.col("doc_id")))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.summary(table(spark, folder, "documents"), crc_text(F.col("doc_id")))


def op13_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licence_scan.summary(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f for f in (
        op1_token_files, op2_toxicity, op3_cotraining, op4_one_bit_codes, op5_ngram_join, op6_bpe, op7_context_tree, op8_warc,
        op9_winnowing, op10_mixing, op11_merkle, op12_periodic_runs, op13_licence_scan,
    )
}

SQL: dict[str, str] = {"op11_merkle": merkle.sql()}
