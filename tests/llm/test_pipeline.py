"""Every stage on its own input, against what its operator decides."""

import brute
import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from rowloom.llm import cotraining, mixing, toxicity
from rowloom.sources.session import materialize

import __spark_entry__ as driver

OPERATORS = ["op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_", "op11_", "op12_", "op13_"]


def test_registered():
    names = list(driver.queries())
    assert "pipeline" in names and all(sum(n.startswith(o) for n in names) == 1 for o in OPERATORS)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.withColumn("_quality", F.lit("clash")).unionByName(docs.limit(1).withColumn("_quality", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long")))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    ids = lambda df: sorted((r[0] for r in df.select("doc_id").collect()), key=lambda k: (k is not None, k or 0))
    before = docs
    for name, stage in pipeline.STAGES:
        after = materialize(stage(spark, before, folder), "test-stage")
        if stage is not pipeline.tokens:
            assert after.columns == docs.columns, name
        if stage is pipeline.quality:
            model = cotraining.fit(before, labels, "quality", F.lit(True))
            assert ids(after) == ids(cotraining.with_score(before, model).filter("score >= 0.5"))
        if stage is pipeline.toxic:
            model = toxicity.fit(before, labels, "toxic", F.lit(True))
            assert ids(after) == ids(toxicity.with_score(before, model).filter("score < 0.5"))
        if stage is pipeline.near_copies:
            found = brute.near_copies([(i, r.text) for i, r in enumerate(before.collect())])
            assert after.count() == len({c for _, _, c in found})
            assert after.select("doc_id", "text").exceptAll(before.select("doc_id", "text")).isEmpty()
        if stage is pipeline.mix:
            taken = sum(r.taken for r in mixing.mix(before, pipeline.WEIGHTS).collect())
            assert sum(len(brute.words(r.text)) for r in after.collect()) == taken
        if stage is pipeline.tokens:
            assert ids(after) == ids(before)
            assert after.join(before.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("h")), "doc_id").filter("h <> decoded_sha256").isEmpty()
        before = after


def small(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def table_of_copies():
    """Texts, the same rows again, near copies under one doc_id, and rows without one."""
    long = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    rows = [(i, long(i % 7) if i % 3 else f"{long(i % 7)} end", "en", f"s{i % 2}", i) for i in range(20)]
    rows += rows[:12] + [(None, long(k), "en", "s0", 1) for k in (1, 2, 50, 50)] + [(30, long(9), "en", "s1", 2), (30, long(9) + " more", "de", "s1", 3)]
    return rows + [(40, None, None, None, None), (41, "", "en", "s0", 0), (42, " ", "en", "s0", 1), (None, "few words", None, "s1", 9)]


def test_one_row_of_each_group_stays(spark, folder):
    rows = table_of_copies()
    for some in (rows, rows + rows, [(None, *r[1:]) for r in rows], rows[:1], []):
        found = brute.near_copies([(i, r[1]) for i, r in enumerate(some)])
        members = {}
        for i, _, c in found:
            members.setdefault(c, []).append(some[i])
        got = [tuple(r) for r in pipeline.near_copies(spark, small(spark, some), folder).collect()]
        assert len(got) == len(members)
        for group in members.values():  # of a group the smallest doc_id stays, a row without one only if none has one
            least = min(((r[0] is None, r[0] or 0) for r in group))
            assert any((r[0] is None, r[0] or 0) == least and r in got for r in group)


def test_every_row_is_taken_as_often_as_the_mix_says(spark, folder):
    rows = table_of_copies()
    for some in (rows, rows + rows, [(None, *r[1:]) for r in rows], rows[:1], []):
        docs = small(spark, some)
        first, again = ([tuple(r) for r in pipeline.mix(spark, d, folder).collect()] for d in (docs, docs.repartition(5)))
        # Rows alike in id, text and source may be exchanged.
        assert brute.ordered((r[0], r[1], r[3]) for r in first) == brute.ordered((r[0], r[1], r[3]) for r in again)
        mixed = mixing.mix(docs, pipeline.WEIGHTS).collect()
        assert len(mixed) == len(some) and len(first) == sum(r.copies for r in mixed)
        assert sum(len(brute.words(r[1])) for r in first) == sum(r.taken for r in mixed)
        assert all(first.count(r) <= 3 * some.count(r) for r in set(first)) and set(first) <= set(some)


def test_equal_rows_are_dealt_over_groups(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 20)
    rows = [(None, "one two three", "en", "s0", 1)] * 500 + [(i, "a b", "en", "s1", 1) for i in range(700)]
    got = mixing.mix(small(spark, rows)).collect()
    targets = {r.source_size: r.target for r in got}
    for size, target in targets.items():
        assert abs(sum(r.taken for r in got if r.source_size == size) - target) <= 3


def test_stages_of_nothing(spark, folder):
    for name, stage in pipeline.STAGES:
        if stage in (pipeline.quality, pipeline.toxic):
            continue  # there is nothing to learn from
        assert stage(spark, small(spark, []), folder).collect() == [], name


@pytest.mark.parametrize("name", [n for n in driver.queries() if n[:2] == "op"])
def test_queries_return_their_columns(spark, folder, name):
    columns = {
        "op1": "doc_id start n_tokens ids_crc32", "op2": "doc_id held_out score predicted", "op3": "doc_id held_out score predicted",
        "op4": "query_id rank vec_id score", "op5": "doc_id n_shingles component_id", "op6": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op7": "doc_id held_out n_tokens n_known train_tokens base_score score", "op8": "page_id payload_bytes payload_digest record_type refers_to",
        "op9": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next", "op10": "doc_id size source_size target taken",
        "op11": "doc_id leaf subroot root proof_sha256 folded_root verified",
        "op12": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
        "op13": "doc_id n_words n_base first_word last_word base_labels labels score",
    }[name.split("_")[0]].split()
    assert set(columns) <= set(driver.queries()[name](spark, folder).columns)
