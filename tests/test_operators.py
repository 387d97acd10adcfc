"""Operators on small tables, against brute force and closed forms."""

import json
import math
import os
import re

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from rowloom import fixed_values as fixed
from rowloom.functions import sparse
from rowloom.functions import text as X
from rowloom.operators import (
    crossval, encode, explain, importance, lookup, metrics, missing, models, network, numbering, order_stats, profile, project, serve, split,
    tfidf, validate, vectors,
)
from rowloom.operators.network import NetworkModel, NetworkRegressor
from rowloom.sources import artifacts, session, tables


@pytest.fixture(scope="module")
def numbers(spark):
    """2000 rows; a third of them share one value."""
    rng = np.random.default_rng(1)
    v = np.where(rng.random(2000) < 0.34, 7.0, np.round(rng.lognormal(3, 2, 2000), 2))
    rows = [(i, float(x) if i % 50 else None) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "id BIGINT, v DOUBLE"), np.sort([x for _, x in rows if x is not None])


@pytest.mark.parametrize("limit", [3, 40, 10_000])
def test_order_statistics_are_exact(numbers, limit):
    df, expected = numbers
    n = len(expected)
    ranks = [0, 1, n // 4, n // 3, n // 2, n - 2, n - 1]
    counts, found = order_stats.order_statistics(df, {"v": lambda _: ranks, "id": lambda m: [m // 2]}, limit)
    assert counts == {"v": n, "id": 2000}
    assert [found["v", r] for r in ranks] == [expected[r] for r in ranks]
    assert found["id", 1000] == 1000


def test_percentiles_and_medians(numbers, spark):
    df, expected = numbers
    shares = [0.1, 0.25, 0.5, 0.99]
    assert order_stats.percentiles(df, "v", shares, 50) == pytest.approx(list(np.percentile(expected, [s * 100 for s in shares])))
    assert order_stats.medians(df, ["v"], 50)["v"] == np.median(expected)
    small = spark.createDataFrame([(1.0, 3.0), (2.0, 1.0), (3.0, 2.0), (10.0, None)], "a DOUBLE, b DOUBLE")
    assert order_stats.medians(small, ["a", "b"]) == {"a": 2.5, "b": 2.0}
    nothing = spark.createDataFrame([(None,)], "a DOUBLE")
    assert order_stats.medians(nothing, ["a"]) == {"a": None}
    assert order_stats.percentiles(nothing, "a", [0.5]) == [None]


def test_mode_takes_the_first_row_on_ties(spark):
    df = spark.createDataFrame(list(enumerate(["b", "a", "b", "a", "", None])), "row_id INT, c STRING")
    assert profile.modes(df, ["c"], "row_id").first()["mode"] == "b"
    assert profile.modes(df.repartition(3), ["c"], "row_id").first()["mode"] == "b"


@pytest.mark.parametrize("percent, tier", [(90.0, "drop"), (89.99, "impute_indicator"), (30.0, "impute_indicator"), (29.99, "impute")])
def test_tiers(spark, percent, tier):
    assert spark.range(1).select(profile.tier(F.lit(percent)).alias("t")).first()["t"] == tier


def test_missing_values(spark, tmp_path):
    rows = [(i, "x" if i % 2 else "", float(i) if i > 3 else None, None, "US" if i else None, None) for i in range(10)]
    df = spark.createDataFrame(rows, "row_id INT, state STRING, views DOUBLE, rare STRING, country STRING, other STRING")
    df = df.withColumn("other", F.when(F.col("row_id") > 4, "o"))
    model = missing.MissingValues().fit(df)
    out = model.transform(df)
    assert out.columns == ["row_id", "state", "views", "country", "other", "state_missing", "views_missing", "other_missing"]
    assert model.values == {"state": "x", "views": 6.5, "country": "Unknown"}
    assert out.filter("state = '' OR views IS NULL OR country IS NULL").count() == 0
    assert out.filter("other IS NULL").count() == 5
    model.write().overwrite().save(str(tmp_path / "m"))
    assert missing.MissingValuesModel.load(str(tmp_path / "m")).transform(df).collect() == out.collect()


def test_one_aggregate_for_all_columns(spark):
    df = spark.range(5).select(*[F.col("id").alias(f"c{i}") for i in range(30)])
    plan = profile.missing_profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range") == 1 or plan.count("Scan") == 1


def test_validation_reasons(spark):
    rows = [("QA", "d" * 25, "50000"), ("  ", "d" * 25, "9999"), ("Dev", "d" * 19, "abc"), ("Dev", "d" * 20, "1000000"), ("Dev", "d" * 20, None)]
    df = spark.createDataFrame(rows, "title STRING, description STRING, salary_normalized STRING")
    assert [r[0] for r in df.select(validate.reasons()).collect()] == [
        ["title: Too short (2 chars, min 3)"],
        ["title: MISSING or EMPTY", "salary_normalized: $9,999 < min $10,000"],
        ["description: Too short (19 chars, min 20)", "salary_normalized: Not a valid number"],
        [],
        ["salary_normalized: MISSING or EMPTY"],
    ]
    assert validate.valid_rows(df).count() == 1
    assert validate.rejected_rows(df).columns == [*df.columns, "validation_errors"]
    assert {r["field"]: r["count"] for r in validate.reason_counts(df).collect()} == {"title": 2, "description": 1, "salary_normalized": 3}


def test_type_inference_reads_first_rows_only(spark):
    rows = [(i, "" if i < 3 else "7", "x" if i else "1", "" if i < 150 else "9") for i in range(200)]
    df = spark.createDataFrame(rows, "row_id INT, a STRING, b STRING, late STRING")
    assert validate.numeric_columns(df, "row_id") == ["a", "b"]


def test_projection(spark):
    assert project.keep_columns(["job_id", "title", "city"]) == ["title", "city", "salary_normalized"]
    assert project.keep_columns(["a", "salary_yearly_med", "b"], dropped=()) == ["a", "salary_yearly_med", "salary_normalized", "b"]
    df = spark.range(20).withColumn("v", F.col("id") * 2)
    assert project.row_at(df, "id", 3).first()["v"] == 6
    with pytest.raises(IndexError):
        project.row_at(df, "id", 20)
    assert project.enough_rows(df, 20) and not project.enough_rows(df, 21)
    assert project.first_rows(df, "id", 99).count() == 20
    assert project.encoded_columns(["title", "state", "views", "benefits_list_missing", "currency"]) == ["views", "benefits_list_missing"]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_lookup_join_with_a_hot_key(spark, limit):
    large = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 2000)).alias("k"))
    large = large.unionByName(spark.createDataFrame([(-1, None)], "id BIGINT, k STRING"))
    table = spark.range(1500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("x")).unionByName(
        spark.createDataFrame([("hot", -5)], "k STRING, x BIGINT"))
    got = {r["id"]: r["x"] for r in lookup.lookup_join(large, table, "k", "left", limit).collect()}
    assert len(got) == 3001
    assert all(got[i] == (-5 if i % 3 == 0 else (i % 2000 if i % 2000 < 1500 else None)) for i in range(3000))
    assert got[-1] is None


def test_frequency_and_one_hot(spark):
    df = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y")], "id INT, city STRING")
    out = encode.frequency_encode(df, F.col("city"), "f").orderBy("id").collect()
    assert [r["f"] for r in out] == pytest.approx([math.log(3) / math.log(4)] * 2 + [0.5])
    unseen = encode.frequency_encode(df, F.col("city"), "f", fit_on=df.filter("city = 'x'"))
    assert unseen.filter("id = 2").first()["f"] == 0.0
    assert [c for c in df.select(*encode.one_hot_columns(df, "city")).columns] == ["city_x", "city_y"]


def test_tfidf_formula(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b a"), (2, "a"), (3, "c"), (4, "")], "id INT, t STRING").filter("id < 4")
    docs = docs.withColumn("words", X.words("t"))
    model = tfidf.TermWeights(max_features=10, min_df=1, max_df=1.0).fit(docs)
    got = {(r["id"], r["term"]): r["weight"] for r in model.long(docs, "id").collect()}
    assert got == pytest.approx({(1, "a"): 0.835592, (1, "b"): 0.549351, (2, "a"): 1.0, (3, "c"): 1.0}, abs=1e-6)
    norms = [float(np.linalg.norm(r["weights"].toArray())) for r in model.transform(docs).collect()]
    assert norms == pytest.approx([1.0] * 3)
    model.write().overwrite().save(str(tmp_path / "t"))
    again = tfidf.TermWeightsModel.load(str(tmp_path / "t"))
    assert again.transform(docs).select("weights").collect() == model.transform(docs).select("weights").collect()
    nothing = tfidf.TermWeights(min_df=9).fit(docs)
    assert nothing.long(docs, "id").count() == 0


def test_terms_need_no_python_and_one_shuffle(spark):
    docs = spark.range(10).select(F.col("id"), F.lit("a b c").alias("t"))
    plan = tfidf.term_counts(tfidf.with_terms(docs, "t", "title", "terms"), "terms")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1
    assert plan.count("regexp_replace(regexp_replace") <= 1


@pytest.mark.parametrize("longest", [2, 3])
@pytest.mark.parametrize("features", [3, 12, 40, 500])
def test_vocabulary_equals_counting_everything(spark, longest, features):
    rng = np.random.default_rng(features + longest)
    texts = [" ".join(f"w{min(int(w), 30)}" for w in rng.zipf(1.4, rng.integers(1, 40))) for _ in range(150)]
    cf, df = {}, {}
    for t in texts:
        w = t.split()
        grams = [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        for g in grams:
            cf[g] = cf.get(g, 0) + 1
        for g in set(grams):
            df[g] = df.get(g, 0) + 1
    kept = sorted((g for g in cf if 3 <= df[g] <= 0.6 * 150), key=lambda g: (-cf[g], g))[:features]
    docs = spark.createDataFrame([(t,) for t in texts], "t STRING").select(X.words("t").alias("w"))
    # The words as a list in the plan, as a set in the tasks, and not at all.
    for word_list, word_set in ((20_000, 0), (2, 1 << 20), (2, 0)):
        got = tfidf.vocabulary(docs, "w", 150, features, 3, 0.6, longest, word_list, word_set).collect()
        assert {r["term"]: (r["cf"], r["df"]) for r in got} == {g: (cf[g], df[g]) for g in kept}


def test_word_means(spark):
    table = spark.createDataFrame([("u", [1.0, 0.0]), ("v", [0.0, 1.0])], "word STRING, vec ARRAY<FLOAT>")
    docs = spark.createDataFrame([(1, ["u", "u", "v", "zzz"]), (2, ["zzz"]), (3, []), (4, ["V"])], "id INT, w ARRAY<STRING>")
    for limit in (0, 1 << 20):
        got = {r["id"]: r["vector"] for r in vectors.pool_words(docs, "id", "w", table, 2, limit=limit).collect()}
        assert got == {1: pytest.approx([2 / 3, 1 / 3]), 2: [0, 0], 3: [0, 0], 4: [0, 0]}
    got = {r["id"]: r["vector"] for r in vectors.pool_words(docs, "id", "w", table, 2, retry_lower=True).collect()}
    assert got[4] == [0, 1] and got[2] == [0, 0] and len(got) == 4


def test_pooling_shuffles_rare_words_only(spark, monkeypatch):
    """Tasks hold the most frequent words up to the limit, with or without a vector; sums are the same at any limit."""
    table = spark.createDataFrame([(w, [float(i), 1.0]) for i, w in enumerate("abcdef")], "word STRING, vec ARRAY<FLOAT>")
    words = [["a"] * 5 + ["zz"] * 9 + ["B", "c"], ["A", "a", None, "zz", "x"], [], None, ["d", "e", "e", "F"], ["a", "zz", "f"]]
    docs = spark.createDataFrame([(i % 5, w) for i, w in enumerate(words)], "id INT, w ARRAY<STRING>").repartition(3)
    left, write = [], vectors.materialize

    def watched(df, name="stage"):
        held = write(df, name)
        if name == "pooled":
            left.append(sum(len(r["rest"]) for r in held.collect()))
        return held

    monkeypatch.setattr(vectors, "materialize", watched)
    for retry in (False, True):
        want = {r["id"]: r["vector"] for r in vectors.pool_words(docs, "id", "w", table, 2, retry_lower=retry).collect()}
        assert want[1] == [0, 1] and want[3] == [0, 0]
        left.clear()
        for limit in (0, 200, 400):
            got = {r["id"]: r["vector"] for r in vectors.pool_words(docs, "id", "w", table, 2, retry_lower=retry, limit=limit).collect()}
            assert got == {k: pytest.approx(v) for k, v in want.items()}
        # 27 words; 11 times zz, which has no vector, and 7 times a come first.
        assert left[0] == 27 and left[1] <= 9 and left[2] <= left[1]


def test_splits(spark):
    df = spark.range(1003)
    test = {r["id"] for r in split.hash_split(df, "id")[1].collect()}
    assert test == {r["id"] for r in split.hash_split(df.repartition(7), "id")[1].collect()}
    exact = split.exact_split(df, "id").filter("is_test").count()
    assert exact == math.ceil(0.2 * 1003)
    seven = spark.createDataFrame([(i * i,) for i in range(7)], "id BIGINT").repartition(3)
    folds = [r["fold"] for r in split.with_folds(seven, "id", 3).orderBy("id").collect()]
    assert folds == [1, 1, 1, 2, 2, 3, 3]
    assert [r["fold"] for r in split.with_folds(seven.limit(0), "id", 3).collect()] == []


def test_metrics(spark):
    df = spark.createDataFrame([(1, 100.0, 110.0), (2, 200.0, 190.0), (3, 300.0, 330.0)], "id INT, label DOUBLE, prediction DOUBLE")
    row = metrics.regression_metrics(df).first()
    assert (row.mse, row.rmse, row.mae, row.r2, row.mape) == pytest.approx((366.666667, 19.148542, 16.666667, 0.945, 8.333333))
    errors = spark.createDataFrame([(0.0, e) for e in (4999.99, 5000.0, 10000.0, 50000.0)], "label DOUBLE, prediction DOUBLE")
    assert [r["count"] for r in metrics.error_bins(errors).orderBy("bin").collect()] == [1, 1, 1, 0, 1]
    assert [r["row"] for r in metrics.best_and_worst(df, "id", n=1).collect()] == [1, 3]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1200, 3)) * [1, 5, 0.1] + [0, 100, 3]
    y = 1000 + x @ [30.0, -2.0, 500.0] + rng.normal(size=1200)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id BIGINT, a DOUBLE, b DOUBLE, c DOUBLE, label DOUBLE")
    return models.assemble(df, ["a", "b", "c"]).cache(), x, y


def test_scaler_and_ridge_closed_form(planted):
    df, x, y = planted
    scaler = models.PopulationScaler().fit(df)
    z = (x - x.mean(0)) / x.std(0)
    got = np.array([r["scaled"].toArray() for r in scaler.transform(df).orderBy("id").collect()])
    assert got == pytest.approx(z)
    for alpha in (1.0, 50.0):
        model = models.Ridge("scaled", alpha=alpha).fit(scaler.transform(df))
        w = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
        assert model.coefficients.toArray() == pytest.approx(w, rel=1e-8)


def test_cross_validation_against_refits(planted):
    df, x, y = planted
    folded = split.with_folds(df, "id", 5)
    sets = {"ab": [0, 1], "all": [0, 1, 2]}
    got = {(r["approach"], r["fold"]): r for r in crossval.cross_validate(folded, sets).collect()}
    parts = np.array_split(np.arange(1200), 5)
    for name, cols in sets.items():
        for f, held in enumerate(parts, 1):
            rest = np.setdiff1d(np.arange(1200), held)
            z = np.column_stack([np.ones(len(rest)), x[rest][:, cols]])
            w = np.linalg.lstsq(z, y[rest], rcond=None)[0]
            p = np.column_stack([np.ones(len(held)), x[held][:, cols]]) @ w
            e = y[held] - p
            row = got[name, f]
            assert row["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()), rel=1e-6)
            assert row["mae"] == pytest.approx(np.abs(e).mean(), rel=1e-6)
            assert row["r2"] == pytest.approx(1 - (e ** 2).sum() / ((y[held] - y[held].mean()) ** 2).sum(), rel=1e-6)


def test_solve_handles_collinear_features():
    rng = np.random.default_rng(3)
    a = rng.normal(size=200)
    z = np.column_stack([np.ones(200), a, a, np.zeros(200), 2 * a + 1])
    w, b = crossval.solve(z.T @ z, [0, 1, 2])
    assert w == pytest.approx([1, 1, 0]) and b == pytest.approx(1)


def test_network_learns_saves_and_ignores_partitioning(planted, tmp_path):
    df, _, _ = planted
    scaled = models.PopulationScaler().fit(df).transform(df)
    make = lambda: NetworkRegressor("scaled", hidden=(16, 8), epochs=25, step=0.01, batch=50, slices=2)
    model = make().fit(scaled)
    r2 = metrics.regression_metrics(model.transform(scaled)).first()["r2"]
    assert r2 > 0.95 and model.validation_r2 > 0.9
    for parts in (1, 7, 40):
        other = make().fit(scaled.repartition(parts))
        assert other.weights == pytest.approx(model.weights, abs=1e-9)
    session = scaled.sparkSession
    before = session.conf.get("spark.sql.files.maxPartitionBytes")
    session.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert make().fit(scaled).weights == pytest.approx(model.weights, abs=1e-9)
    finally:
        session.conf.set("spark.sql.files.maxPartitionBytes", before)
    path = str(tmp_path / "n")
    Pipeline(stages=[model]).fit(scaled).write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert isinstance(again.stages[0], NetworkModel)
    pick = lambda m: [r["prediction"] for r in m.transform(scaled).orderBy("id").limit(50).collect()]
    assert pick(again) == pytest.approx(pick(model))


def test_network_in_one_stage_equals_a_job_per_epoch(planted, monkeypatch):
    df, _, _ = planted
    scaled = models.PopulationScaler().fit(df).transform(df)
    make = lambda **o: NetworkRegressor("scaled", hidden=(8,), epochs=12, step=0.01, batch=50, slices=5, patience=3, **o)
    monkeypatch.setattr(network, "SAVE_EVERY", 4)
    stage, jobs = make().fit(scaled), make(oneStage=False).fit(scaled)
    assert stage.weights == pytest.approx(jobs.weights, abs=1e-9)
    assert (stage.epochs, stage.validation_r2) == (jobs.epochs, pytest.approx(jobs.validation_r2))
    monkeypatch.setattr(network, "FAN_IN", 2)  # several levels of adding
    assert make().fit(scaled).weights == pytest.approx(jobs.weights, abs=1e-9)
    monkeypatch.setattr(network, "HELD_BYTES", 10)  # too much for the tasks of one stage
    assert make().fit(scaled).weights == pytest.approx(jobs.weights, abs=1e-9)


def test_network_goes_on_from_its_saved_state(planted, monkeypatch, tmp_path):
    df, _, _ = planted
    scaled = models.PopulationScaler().fit(df).transform(df)
    make = lambda: NetworkRegressor("scaled", hidden=(8,), epochs=9, step=0.01, batch=50, slices=3)
    monkeypatch.setattr(network, "SAVE_EVERY", 4)
    monkeypatch.setattr(network, "new_path", lambda spark, name: str(tmp_path / "first"))
    whole = make().fit(scaled)
    states = sorted(f for f in os.listdir(tmp_path / "first") if f.startswith("state-"))
    assert [int(f[6:15]) for f in states] == [4, 8, 9]
    # What a repeated stage finds after the fourth epoch; where it would start otherwise makes no difference.
    (tmp_path / "again").mkdir()
    (tmp_path / "again" / states[0]).write_bytes((tmp_path / "first" / states[0]).read_bytes())
    monkeypatch.setattr(network, "new_path", lambda spark, name: str(tmp_path / "again"))
    monkeypatch.setattr(network, "_start", lambda sizes, seed: np.zeros(sum((a + 1) * b for a, b in zip(sizes, sizes[1:]))))
    assert make().fit(scaled).weights == pytest.approx(whole.weights, abs=1e-9)


def test_network_survives_a_lost_task(planted, monkeypatch, tmp_path):
    df, _, _ = planted
    scaled = models.PopulationScaler().fit(df).transform(df)
    make = lambda: NetworkRegressor("scaled", hidden=(8,), epochs=9, step=0.01, batch=50, slices=3)
    monkeypatch.setattr(network, "SAVE_EVERY", 4)
    whole, save, mark = make().fit(scaled), network._Meeting.save, str(tmp_path / "lost")

    def save_and_die_once(meeting, p):
        save(meeting, p)
        if p.epoch == 8 and not os.path.exists(mark):
            open(mark, "w").close()
            raise RuntimeError("an executor is lost")

    monkeypatch.setattr(network._Meeting, "save", save_and_die_once)
    assert make().fit(scaled).weights == pytest.approx(whole.weights, abs=1e-9)
    assert os.path.exists(mark)


def test_linear_network_finds_least_squares(planted):
    df, x, y = planted
    scaled = models.PopulationScaler().fit(df).transform(df)
    model = NetworkRegressor(
        "scaled", hidden=(), epochs=400, step=0.02, batch=2000, slices=1, l2=0.0, validation_share=0.0, patience=500,
    ).fit(scaled)
    z = (x - x.mean(0)) / x.std(0)
    w = np.linalg.lstsq(np.column_stack([z, np.ones(len(z))]), y, rcond=None)[0]
    got = model.weights * model.getOrDefault("labelStd")
    assert got[:3] == pytest.approx(w[:3], rel=1e-3)
    assert got[3] + model.getOrDefault("labelMean") == pytest.approx(w[3], rel=1e-3)


def test_permutation_importance_finds_the_signal(planted, spark):
    df, _, _ = planted
    model = models.least_squares().fit(df)
    rows = importance.permutation_importance(model, df, "id", ["a", "b", "c"], rows=300, repeats=3).collect()
    got = {r["feature"]: r["importance"] for r in rows}
    assert sum(got.values()) == pytest.approx(1.0)
    assert got["c"] > got["a"] > got["b"] > 0
    again = importance.permutation_importance(model, df.repartition(5), "id", ["a", "b", "c"], rows=300, repeats=3).collect()
    assert {r["feature"]: r["importance"] for r in again} == pytest.approx(got)


def test_permutation_importance_nears_its_expectation(planted, spark, monkeypatch):
    df, x, y = planted
    model = models.least_squares().fit(df)
    w, e = model.coefficients.toArray(), y - x @ model.coefficients.toArray() - model.intercept
    # The mean over all permutations is the mean over all pairs of rows.
    drops = [((e[:, None] + w[f] * (x[:, None, f] - x[None, :, f])) ** 2).mean() - (e ** 2).mean() for f in range(3)]
    want = np.array(drops) / np.sum(drops)
    expected = {r["feature"]: r["importance"] for r in importance.expected_permutation_importance(model, df, ["a", "b", "c"]).collect()}
    assert [expected[f] for f in "abc"] == pytest.approx(want, rel=1e-9)
    sampled = lambda **o: {r["feature"]: r["importance"] for r in importance.permutation_importance(model, df, "id", ["a", "b", "c"], **o).collect()}
    assert [sampled(repeats=8)[f] for f in "abc"] == pytest.approx(want, abs=0.01)
    monkeypatch.setattr(importance, "DONOR_BYTES", 8 * 3 * 400)  # a third of the rows are donors
    assert [sampled(repeats=8)[f] for f in "abc"] == pytest.approx(want, abs=0.04)
    nothing = df.filter("false")
    assert importance.permutation_importance(model, nothing, "id", ["a", "b", "c"]).collect() == []
    assert importance.expected_permutation_importance(model, nothing, ["a", "b", "c"]).collect() == []
    with pytest.raises(TypeError):
        importance.scorer(object())


def test_network_is_scored_in_place_as_by_transform(spark):
    rng = np.random.default_rng(4)
    for sizes in ([4, 1], [4, 3, 1], [4, 6, 5, 1]):
        n = sum((a + 1) * b for a, b in zip(sizes, sizes[1:]))
        scorer = NetworkModel(sizes=sizes, weights=rng.normal(size=n), mean=3.0, std=2.0).scorer()
        x, by = rng.normal(size=(20, 4)), rng.normal(size=20)
        state, p = scorer.start(x)
        for feature in range(4):
            moved = x.copy()
            moved[:, feature] += by
            assert scorer.changed(state, feature, by) == pytest.approx(scorer.start(moved)[1])
        model = NetworkModel(sizes=sizes, weights=scorer.weights, mean=3.0, std=2.0)
        frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id INT, v ARRAY<DOUBLE>").withColumn("features", array_to_vector("v"))
        assert [r["prediction"] for r in model.transform(frame).orderBy("id").collect()] == pytest.approx(p)


def stump(x, y, least=2):
    """The best split of one feature between two values: its predictions."""
    best = None
    for cut in np.unique(x)[:-1]:
        left = x <= cut
        if min(left.sum(), (~left).sum()) >= least:
            loss = ((y[left] - y[left].mean()) ** 2).sum() + ((y[~left] - y[~left].mean()) ** 2).sum()
            if best is None or loss < best[0] - 1e-9:
                best = loss, np.where(left, y[left].mean(), y[~left].mean())
    return best[1]


def test_trees_against_a_brute_force_stump(spark):
    rng = np.random.default_rng(8)
    x = np.repeat(np.arange(20.0), 6)
    y = np.where(x < 7, 3.0, 9.0) + x * 0.2 + rng.normal(size=len(x))
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = models.assemble(spark.createDataFrame(rows, "id BIGINT, a DOUBLE, label DOUBLE"), ["a"])
    found = lambda model: [r["prediction"] for r in model.transform(df).orderBy("id").collect()]
    forest = models.forest("features", trees=1, depth=1).setBootstrap(False).fit(df)
    assert found(forest) == pytest.approx(stump(x, y))
    assert importance.tree_importance(spark, forest, ["a"], "f").first()["importance"] == 1.0
    first = stump(x, y)
    boosted = models.boosting("features", trees=2, depth=1, row_share=1.0, column_share=1.0).fit(df)
    assert found(boosted) == pytest.approx(first + 0.1 * stump(x, 2 * (y - first)))


def test_tree_importance_is_the_share_of_variance_removed(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2, size=(400, 2)).astype(float)
    y = 10 * x[:, 0] + 3 * x[:, 1]
    rows = [(float(a), float(b), float(t)) for (a, b), t in zip(x, y)]
    df = models.assemble(spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, label DOUBLE"), ["a", "b"])
    model = models.boosting("features", trees=1, depth=2, row_share=1.0, column_share=1.0).fit(df)
    got = {r["feature"]: r["importance"] for r in importance.tree_importance(spark, model, ["a", "b"], "t").collect()}
    # Split by a first, then by b on either side: what each removes of the sum of squares.
    total = ((y - y.mean()) ** 2).sum()
    left = sum(((y[x[:, 0] == v] - y[x[:, 0] == v].mean()) ** 2).sum() for v in (0, 1))
    assert got["a"] == pytest.approx((total - left) / total) and got["b"] == pytest.approx(left / total)


def test_models_are_compared_and_explained_at_once(planted, spark):
    df, _, _ = planted
    ready = models.PopulationScaler().fit(df).transform(df).withColumn("key", F.col("id").cast("string"))
    train, test = split.hash_split(ready, "key")
    make = {
        "Ridge": lambda: models.Ridge("scaled"), "Forest": lambda: models.forest("scaled", trees=5, depth=4),
        "Network": lambda: NetworkRegressor("scaled", hidden=(8,), epochs=15, step=0.02, batch=50),
    }
    got = explain.explain_models(train, test, make, "key", ["a", "b", "c"], "scaled")
    rows = {r["name"]: r for r in got.scores.collect()}
    assert list(got.models) == list(make) and set(rows) == set(make)
    for name, make_one in make.items():
        alone = crossval.evaluate(train, test, name, make_one())[1].first()
        numbers = [c for c in alone.asDict() if c not in ("name", "overfitting_status")]
        # A forest's random rows depend on how the table is cut.
        close = {"rel": 0.2, "abs": 0.02} if name == "Forest" else {"rel": 1e-6, "abs": 1e-9}
        assert [rows[name][c] for c in numbers] == pytest.approx([alone[c] for c in numbers], **close)
        assert rows[name]["overfitting_status"] == alone["overfitting_status"]
    assert [r["rank"] for r in got.top(2).orderBy("rank").collect()] == [1, 2]
    per_model = got.importances.groupBy("model").agg(F.sum("importance").alias("s"), F.max_by("feature", "importance").alias("f"))
    assert {(r["model"], round(r["s"], 9), r["f"]) for r in per_model.collect()} == {(n, 1.0, "c") for n in make}
    assert got.by_type().count() == 3 and got.types().count() == 1
    assert got.consistent().count() == 3 and got.advice().count() > 0
    with pytest.raises(Exception, match="no rows to train on"):
        crossval.fit_all(train.filter("false"), {"Network": make["Network"]})


def test_importance_is_unchanged_when_its_sum_is_not_positive(spark):
    rows = spark.createDataFrame([("m", "a", -1.0), ("m", "b", 0.5)], "model STRING, feature STRING, importance DOUBLE")
    assert {r["importance"] for r in importance.normalized(rows).collect()} == {-1.0, 0.5}


def test_recommendations(spark):
    rows = [("m1", "x_tfidf_a", 0.7), ("m1", "views", 0.295), ("m1", "country_binary", 0.005), ("m2", "x_tfidf_a", 1.0)]
    df = importance.with_type(spark.createDataFrame(rows, "model STRING, feature STRING, importance DOUBLE"))
    got = {(r["rule"], r["subject"]) for r in importance.recommendations(df).collect()}
    assert {("top_type", "TF-IDF"), ("remove_type", "Binary"), ("strong_type", "TF-IDF"), ("consistent_feature", "x_tfidf_a")} <= got
    assert not any(rule == "reduce_features" for rule, _ in got)


def test_train_save_load_score(planted, spark, tmp_path):
    df, _, _ = planted
    raw = df.select("id", F.col("a").cast("string").alias("a"), "b", "c", F.col("label").alias("salary_normalized"))
    features = ["a", "b", "c", "absent"]
    with pytest.raises(ValueError):
        serve.train(raw.limit(99), "id", features[:3], "salary_normalized", models.least_squares("scaled"))
    model, scores = serve.train(raw, "id", features[:3], "salary_normalized", models.Ridge("scaled"))
    assert scores.filter("dataset = 'test'").first()["r2"] > 0.99
    paths = artifacts.save_model(spark, model, features[:3], {"r2": 1.0}, str(tmp_path / "m"))
    loaded, manifest, metadata = artifacts.load_model(spark, str(tmp_path / "m"))
    assert set(paths) == {"model", "features", "metadata"} and manifest == features[:3] and metadata["n_features"] == 3
    before = serve.score(raw, model, manifest, "id", "salary_normalized").orderBy("row_index").collect()
    after = serve.score(raw, loaded, manifest, "id", "salary_normalized").orderBy("row_index").collect()
    assert before == after and after[0]["title"] == "N/A"
    assert serve.mean_errors(serve.score(raw, loaded, manifest, "id", "salary_normalized")).first()["rows"] == 1200
    aligned = raw.select(*serve.align(raw, features)).first()
    assert aligned["absent"] == 0.0 and isinstance(aligned["a"], float)
    with pytest.raises(Exception):
        artifacts.load_model(spark, str(tmp_path / "none"))


def test_prediction_report_without_an_actual_value(spark):
    df = spark.createDataFrame([(1, 5.0, None, "t", "c"), (2, 5.0, 0.0, "t", "c"), (3, 5.0, 4.0, "t", "c")],
                               "row_index INT, predicted DOUBLE, actual DOUBLE, title STRING, company STRING")
    assert [(r["error"], r["error_pct"]) for r in serve.prediction_report(df).orderBy("row_index").collect()] == [(None, None), (None, None), (1.0, 25.0)]


def test_csv_and_row_ids(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [("a", 'say "hi", | ok'), ("b", "two\nlines"), ("c", "")]
    df = spark.createDataFrame(rows, "k STRING, t STRING").withColumn("extra", F.lit(1)).coalesce(1)
    tables.write_csv(df, path, ["k", "t"])
    back = tables.with_row_id(tables.read_csv(spark, path)).orderBy("row_id").collect()
    assert [(r["k"], r["t"]) for r in back] == [("a", 'say "hi", | ok'), ("b", "two\nlines"), ("c", None)]
    assert [r["row_id"] for r in back] == [0, 1, 2]


def test_feature_choice(spark):
    base = spark.range(3).withColumnRenamed("id", "row_id")
    blocks = {"title_terms": base.withColumn("x", F.lit(1)), "title_vectors": base.withColumn("y", F.lit(2))}
    choice = tables.FeatureChoice(title_vectors=False, description_vectors=False)
    assert tables.join_blocks(base, blocks, choice).columns == ["row_id", "x"]
    assert choice.table_name() == "with_tfidf_only" and tables.FeatureChoice().table_name() == "with_nlp_features"


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    df = spark.range(5)
    assert session.materialize(df).count() == 5


def test_hybrid_features(spark):
    docs = spark.createDataFrame([(i, "red fox runs", "fox|red" if i % 2 else "") for i in range(8)], "id INT, title STRING, all_skills STRING")
    table = spark.createDataFrame([("fox", [1.0, 0.0]), ("red", [0.0, 1.0])], "word STRING, vec ARRAY<FLOAT>")
    out, names = vectors.hybrid_features(docs, "id", {"title": "title", "all_skills": "all_skills"}, table, 2)
    row = out.filter("id = 0").select(vector_to_array("features").alias("f")).first()["f"]
    assert len(row) == len(names) and names[:2] == ["all_skills_tfidf_fox", "all_skills_tfidf_red"] or names[0].startswith("title")
    at = {n: v for n, v in zip(names, row)}
    assert at["title_w2v_0"] == 0.5 and at["all_skills_w2v_0"] == 0.0
    assert out.count() == 8 and json.dumps(names)


def test_stateless_expressions_take_a_stream(spark, tmp_path):
    spark.createDataFrame([("A b@c.de x",)], "t STRING").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t STRING").parquet(str(tmp_path / "in"))
    query = stream.select(X.clean_text("t").alias("t")).writeStream.format("memory").queryName("cleaned").start()
    try:
        query.processAllAvailable()
        assert spark.table("cleaned").first()["t"] == "a x"
    finally:
        query.stop()


def test_fixed_values_are_consistent():
    assert len(fixed.NON_ESSENTIAL) == 34 and len(fixed.CRITICAL_FIELDS) == 3


def test_order_statistics_tell_large_integers_apart(spark):
    values = [2**60 + 1] * 120 + [2**60 + 3] * 80 + [-(2**62)] * 3 + [2**62 + k for k in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    ranks = [0, 2, 3, 60, 122, 123, 202, 203, 230, 262]
    _, got = order_stats.order_statistics(df, {"v": lambda n: ranks}, limit=10)
    assert [got["v", r] for r in ranks] == [sorted(values)[r] for r in ranks]


def test_fold_products_of_many_tasks(spark):
    rows = [(i % 3, [float(i), float(i * i % 7)], float(3 * i + 1) if i % 10 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "fold int, x array<double>, label double").repartition(200)
    df = df.select("fold", array_to_vector("x").alias("features"), "label")
    got = crossval.cross_validate(df, {"first": [0], "both": [0, 1]}).collect()
    assert len(got) == 6 and all(r["r2"] == pytest.approx(1.0) for r in got)
    assert crossval.cross_validate(df.limit(0), {"first": [0]}).collect() == []


def test_release_removes_what_was_written(spark, monkeypatch):
    monkeypatch.setattr(session, "_written", [])
    written = session.materialize(spark.range(5), "gone")
    path = session._written[-1]
    assert os.path.isdir(path) and written.count() == 5
    assert session.release(spark) >= 1 and not os.path.exists(path)


def csv_text(rows, end):
    quote = lambda c: '"' + c.replace('"', '""') + '"' if re.search(r'[",\r\n]', c) or not c else c
    return "".join(",".join(map(quote, r)) + end for r in [["a", "b", "c"], *rows])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [37, 200, 100_000])
def test_csv_ranges_equal_one_task(spark, tmp_path, end, size):
    rng = np.random.default_rng(size)
    cells = ["plain", "", 'say "hi"', "two\nlines", '\n\n"\n', "x" * 90, "a,b", '"', "end\r\nof", "é 中", "5\" pipe, \"\"", "\n" * 60]
    rows = [[str(i), cells[rng.integers(len(cells))], cells[rng.integers(len(cells))]] for i in range(150)]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "one.csv").write_bytes(csv_text(rows[:120], end).encode())
    (folder / "two.csv").write_bytes(csv_text(rows[120:], end).removesuffix(end).encode())
    (folder / "three.csv").write_bytes(csv_text([], end).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = tables.read_csv(spark, str(folder), row_id="id")
        if size < 300:
            assert tables.csv_ranges.records(spark, str(folder)).rdd.getNumPartitions() > 20
        found = got.orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["a"] for r in found] == [r[0] for r in rows]
    assert [[r["a"], r["b"], r["c"]] for r in found] == [[c.replace("\r\n", "\n") or None for c in r] for r in rows]
    whole = [spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(folder / f)).collect() for f in ("one.csv", "two.csv")]
    # The single task's reader keeps CR LF in quotes or not, by the first line break that it meets.
    plain = lambda r: tuple(c and c.replace("\r\n", "\n") for c in r)
    assert [tuple(r)[1:] for r in found] == [plain(r) for part in whole for r in part]


def test_csv_lines_with_stray_quotes():
    for line, opened, want in [
        ('a,"b', False, True), ('a,"b"', False, False), ('a "b,c', False, False), ('"a""', False, True), ('"a"""', False, False),
        ('x","y', True, True), ('x"', True, False), ('x""', True, True), ('x"",y', True, True), ("", True, True), ("", False, False),
        ('"a"b,"', False, True), (',"', False, True), (',""', False, False), ('","', False, False), ('","', True, True),
    ]:
        assert tables.csv_ranges.ends_open(line, opened) is want, (line, opened)


def test_csv_of_nothing(spark, tmp_path):
    (tmp_path / "h.csv").write_text("a,b\n")
    assert tables.read_csv(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("stored", ["dense", "sparse"])
def test_ridge_by_conjugate_gradients_is_the_normal_solution(spark, monkeypatch, stored):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 12)) * rng.choice([0.01, 1.0, 30.0], 12) + rng.choice([0.0, 5.0], 12)
    x[rng.random(x.shape) < 0.6] = 0.0
    x[:, 9] = x[:, 3] + x[:, 4]  # dependent
    for constant in (False, True):
        if constant:
            x[:, 7] = 2.0
        y = 100 + x @ rng.normal(size=12) + rng.normal(size=400)
        rows = [(Vectors.dense(r) if stored == "dense" else Vectors.sparse(12, [(int(i), float(r[i])) for i in np.flatnonzero(r)]), float(t)) for r, t in zip(x, y)]
        df = spark.createDataFrame([*rows, (rows[0][0], None)], ["features", "label"]).repartition(3)
        for alpha in (1.0, 20.0):
            monkeypatch.setattr(models, "NORMAL_SOLVER_FEATURES", 4)
            steps = models.Ridge("features", alpha=alpha).fit(df)
            monkeypatch.undo()
            z = x - x.mean(0)
            w = np.linalg.solve(z.T @ z + alpha * np.eye(12), z.T @ (y - y.mean()))
            assert steps.coefficients.toArray() == pytest.approx(w, rel=1e-8, abs=1e-9)
            assert steps.intercept == pytest.approx(y.mean() - x.mean(0) @ w, rel=1e-8)
            if not constant:  # MLlib's own solver leaves constant features out of the penalty
                normal = models.Ridge("features", alpha=alpha).fit(df.filter("label IS NOT NULL"))
                assert steps.coefficients.toArray() == pytest.approx(normal.coefficients.toArray(), rel=1e-8, abs=1e-9)
                p, q = ([r["prediction"] for r in m.transform(df).collect()] for m in (steps, normal))
                assert p == pytest.approx(q, rel=1e-8)


def test_one_hot_of_large_domains(spark):
    rng = np.random.default_rng(7)
    rows = [(i, f"k{i}" if i % 9 else "  ", str(rng.choice(["x", "y z", ""])), None if i % 5 else "v") for i in range(3000)]
    df = spark.createDataFrame(rows, "id BIGINT, a STRING, b STRING, c STRING").repartition(5)
    found, size = encode.one_hot_vector(df, "id", ["a", "b", "c"])
    clean = lambda v: (v or "").strip() or "missing"
    names = [(k, v) for k in range(3) for v in sorted({clean(r[k + 1]) for r in rows})]
    place = {n: i for i, n in enumerate(names)}
    assert size == len(names)
    got = {r["id"]: r["one_hot"] for r in found.collect()}
    assert {i: sorted(place[k, clean(r[k + 1])] for k in range(3)) for i, r in enumerate(rows)} == {i: v.indices.tolist() for i, v in got.items()}
    assert all(v.size == size and set(v.values) == {1.0} for v in got.values())
    numbers = encode.one_hot_numbers(df.filter("id < 10"), ["a", "b", "c"])
    some, fewer = encode.one_hot_vector(df, "id", ["a", "b", "c"], numbers=numbers)
    assert fewer < size and some.count() == 3000 and some.filter("id = 2000").first()["one_hot"].size == fewer
    assert encode.one_hot_vector(df.limit(0), "id", ["a"])[0].collect() == []


def test_dense_ranks(spark):
    rows = [(i % 3 if i % 7 else None, i % 11) for i in range(500)]
    got = numbering.ranked(spark.createDataFrame(rows, "t INT, v INT").repartition(4), F.col("t"), [F.col("v").asc()]).collect()
    for tree in (None, 0, 1, 2):
        some = sorted((r["rank"], r["v"], r["n"]) for r in got if r["tree"] == tree)
        want = sorted(v for t, v in rows if t == tree)
        assert some == [(i, v, len(want)) for i, v in enumerate(want)]


def test_stored_blocks_join_without_moving_rows(spark):
    ids = spark.range(1000).withColumnRenamed("id", "row_id")
    blocks = {n: ids.withColumn(n, F.col("row_id") * k) for k, n in enumerate(tables.FeatureChoice().blocks())}
    stored = tables.store_blocks(spark, {"base": ids, **blocks}, "row_id", 4)
    choice = tables.FeatureChoice(skills_terms=False)
    joined = tables.join_blocks(stored.pop("base"), stored, choice)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.columns == ["row_id", *choice.blocks()] and joined.count() == 1000
    assert joined.filter("row_id = 7").first()["description_vectors"] == 28


def test_sparse_entries_and_vectors(spark):
    rows = [(1, Vectors.sparse(6, [1, 4], [2.0, 5.0])), (2, Vectors.dense([1.0, 0.0, 3.0])), (3, Vectors.sparse(4, [], []))]
    df = spark.createDataFrame(rows, ["id", "v"])
    cells = df.select("id", F.inline_outer(sparse.entries("v"))).filter("value <> 0").collect()
    assert sorted(map(tuple, cells)) == [(1, 1, 2.0), (1, 4, 5.0), (2, 0, 1.0), (2, 2, 3.0)]
    back = df.withColumn("e", sparse.entries("v")).select("id", sparse.sparse_vector(6, F.transform("e", lambda e: e["index"]), F.transform("e", lambda e: e["value"])).alias("w"))
    assert {r["id"]: r["w"] for r in back.collect()}[1] == rows[0][1]


def test_weights_stay_sparse(spark):
    docs = spark.createDataFrame([(i, [f"w{i % 400}", f"w{(i * 7) % 400}", "all"]) for i in range(800)], "id INT, words ARRAY<STRING>")
    for sublinear in (False, True):
        model = tfidf.TermWeights(max_features=400, min_df=1, max_df=1.0, sublinear=sublinear).fit(docs)
        got = model.transform(docs).select("weights").collect()
        assert all(isinstance(r["weights"], SparseVector) and len(r["weights"].indices) <= 3 for r in got)
        assert [np.linalg.norm(r["weights"].values) for r in got] == pytest.approx([1.0] * len(got))


def test_vector_quality(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(50, 4)), np.where(rng.random((50, 3)) < 0.5, 0.0, 2.0)
    rows = [(Vectors.dense(x), Vectors.sparse(3, [(int(i), float(y[i])) for i in np.flatnonzero(y)])) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, ["a", "b"])
    found = vectors.vector_quality(df, {("f", "a"): "a", ("f", "b"): "b"})
    got = {r["block"]: r for r in found.collect()}
    for name, x in (("a", a), ("b", b)):
        r = got[name]
        assert (r["columns"], r["mean"], r["std"], r["non_zero_percent"]) == pytest.approx((x.shape[1], x.mean(), x.std(), 100 * (x != 0).mean()))
    assert vectors.quality_columns(found).first()["f_b_non_zero_percent"] == pytest.approx(100 * (b != 0).mean())
    assert vectors.vector_quality(df.limit(0), {("f", "a"): "a"}).collect() == []


def test_encoder_of_the_caller(spark):
    def load():
        return lambda texts: np.array([[len(t), t.count("a")] for t in texts], np.float32)

    df = spark.createDataFrame([(i, "a" * (i % 4) + "b" * i) for i in range(40)], "id INT, t STRING").repartition(3)
    got = {r["id"]: r["v"] for r in df.select("id", vectors.encode_batches("t", load, 7).alias("v")).collect()}
    assert got == {i: [i % 4 + i, i % 4] for i in range(40)}


def test_word_vectors_place_planted_synonyms_together(spark):
    """Words that occur in the same contexts are nearer to each other than to words of other contexts."""
    rng = np.random.default_rng(12)
    groups = [["cat", "dog"], ["red", "blue"], ["run", "walk"]]
    contexts = [[f"c{g}x{i}" for i in range(6)] for g in range(3)]
    rows = []
    for _ in range(1500):
        g = int(rng.integers(3))
        words = [str(w) for w in rng.choice(contexts[g], 6)]
        words.insert(3, str(rng.choice(groups[g])))
        rows.append((words,))
    table = spark.createDataFrame(rows, "words ARRAY<STRING>")
    model = vectors.fit_word_vectors(table, "words", partitions=1, size=16, epochs=5)
    v = {r["word"]: np.array(r["vec"]) for r in vectors.vector_table(model).collect()}
    near = lambda a, b: v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b])
    for g, (a, b) in enumerate(groups):
        assert all(near(a, b) > near(a, other) for h, pair in enumerate(groups) if h != g for other in pair)
