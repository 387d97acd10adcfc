"""Fitting, comparing, explaining, saving and serving models on line items and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.encoders import one_hot_name
from ..operators import crossval, encode, explain, importance, metrics, models, serve, split, tfidf, vectors
from ..operators.network import NetworkRegressor
from ..sources.artifacts import load_model, save_model
from ..sources.session import materialize, new_path
from .base import documents, priced_items, sql_hash, table

FLAGS = ("A", "N", "R")
FEATURES = [
    "l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice", "p_size",
    *[one_hot_name("l_returnflag", f) for f in FLAGS],
]
TARGET = "charge"


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with the numeric and one-hot features of a model of the final charge."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    rows = priced_items(spark, folder, busy=True).withColumn(TARGET, charge)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    plain = [c for c in FEATURES if not c.startswith("l_returnflag")]
    return rows.select(
        key.alias("key"), *plain, *encode.one_hot_columns(rows, "l_returnflag", FLAGS), TARGET,
    )


def _split(rows: DataFrame, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """Assembled and scaled (train, test), written once; the scaler sees the training part only."""
    typed = models.typed_features(rows, features, TARGET, ["key"])
    ready = materialize(models.assemble(typed, features).select("key", "features", "label"), "items")
    train, test = split.hash_split(ready, "key")
    scaler = models.PopulationScaler().fit(train)
    return tuple(materialize(scaler.transform(part), "scaled") for part in (train, test))


def _split_items(spark: SparkSession, folder: str, features: list[str] = FEATURES) -> tuple[DataFrame, DataFrame]:
    return _split(items(spark, folder), features)


def _estimators() -> dict:
    """The four models at the production settings."""
    return {
        "Ridge Regression": lambda: models.Ridge("scaled"),
        "MLP Neural Network": lambda: NetworkRegressor("scaled"),
        "Boosted Trees": lambda: models.boosting("scaled"),
        "Random Forest": lambda: models.forest("scaled"),
    }


def _one_model(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        train, test = _split_items(spark, folder)
        _, row, _ = crossval.evaluate(train, test, name, _estimators()[name]())
        return _rounded(row)

    return run


def _rounded(row: DataFrame) -> DataFrame:
    digits = {c: 6 if "r2" in c or "gap" in c else 3 for c in row.columns}
    return row.select(*[
        F.col(c) if c in ("name", "overfitting_status") else F.round(c, digits[c]).alias(c) for c in row.columns
    ])


def evaluate_ridge(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation row of a one-feature ridge model, which has a closed form."""
    train, test = _split_items(spark, folder, ["l_extendedprice"])
    _, row, _ = crossval.evaluate(train, test, "ridge", models.Ridge("scaled"))
    return _rounded(row)


def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    """The ridge model of all nine features, beside the quality of its numeric and one-hot blocks."""
    rows = items(spark, folder)
    typed = models.typed_features(rows, FEATURES, TARGET, ["key"])
    flags = [c for c in FEATURES if c.startswith("l_returnflag")]
    blocks = models.assemble(models.assemble(typed, [c for c in FEATURES if c not in flags], "numeric"), flags, "one_hot")
    quality = vectors.vector_quality(blocks, {("items", "numeric"): "numeric", ("items", "one_hot"): "one_hot"})
    row = crossval.evaluation_report(*_split(rows, FEATURES), "ridge", models.Ridge("scaled"), quality)
    shares = [c for c in row.columns if c.startswith("items_")]
    return _rounded(row.drop(*shares)).crossJoin(row.select(*[F.round(c, 6).alias(c) if c[-7:] != "columns" else F.col(c) for c in shares]))


def compare_models(spark: SparkSession, folder: str) -> DataFrame:
    """Four models on one split, best test R2 first."""
    _, scores, _ = crossval.compare_models(*_split_items(spark, folder), _estimators())
    return scores


def prediction_points(spark: SparkSession, folder: str) -> DataFrame:
    """Actual and predicted values of the test rows, for all four models."""
    return crossval.compare_models(*_split_items(spark, folder), _estimators())[2]


def train_report(spark: SparkSession, folder: str) -> DataFrame:
    """Error percentiles, histogram and extreme rows of a fitted model, in one long table."""
    train, test = _split_items(spark, folder)
    model = crossval.ridge_or_least_squares(train, test, models.Ridge("scaled"), models.least_squares("scaled"))
    scored = materialize(model.transform(test).select("key", "label", "prediction"), "scored")
    shares = metrics.error_percentiles(scored).select(
        F.lit("percentile").alias("what"), F.col("percentile").cast("string").alias("name"), F.col("abs_error").alias("value")
    )
    bins = metrics.error_bins(scored).select(F.lit("bin").alias("what"), F.col("label").alias("name"), "percent")
    rows = metrics.best_and_worst(scored, "key").select("kind", F.col("row").alias("name"), "abs_error")
    return shares.union(bins).union(rows).withColumn("value", F.round("value", 4))


def top_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _split_items(spark, folder)
    return models.top_coefficients(models.least_squares("scaled").fit(train), FEATURES, 20)


def compare_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Importance of every feature in all four models, averaged."""
    return explain.explain_models(*_split_items(spark, folder), _estimators(), "key", FEATURES, "scaled", ("p_",)).top(30)


def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    """What a ridge model loses by a feature, on average over all permutations of all test rows."""
    train, test = _split_items(spark, folder)
    model = models.Ridge("scaled").fit(train)
    found = importance.expected_permutation_importance(model, test, FEATURES, "scaled")
    return found.withColumn("importance", F.round("importance", 9))


def tree_importance(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = _split_items(spark, folder)
    return importance.tree_importance(spark, models.forest("scaled").fit(train), FEATURES, "forest")


def save_load_score(spark: SparkSession, folder: str) -> DataFrame:
    """Train on the training part, save, load, and score all rows with the loaded model."""
    rows, features = items(spark, folder), ["l_extendedprice"]
    model, scores = serve.train(rows, "key", features, TARGET, models.least_squares("scaled"))
    test = scores.filter("dataset = 'test'").first().asDict()
    path = new_path(spark, "model")
    save_model(spark, model, features, {m: test[m] for m in ("r2", "rmse", "mae")}, path)
    loaded, manifest, _ = load_model(spark, path)
    found = serve.score(rows, loaded, manifest, "key", TARGET)
    # Two fits agree to about 1e-7, so predictions are compared in whole units.
    return found.select(
        "row_index", F.round("predicted_salary", 0).alias("predicted_salary"),
        F.round("actual_salary", 6).alias("actual_salary"), F.round("error", 0).alias("error"),
    )


def production_score(spark: SparkSession, folder: str) -> DataFrame:
    """Train on all nine features, save, load, align and score all rows with the loaded model."""
    rows = items(spark, folder)
    model, scores = serve.train(rows, "key", FEATURES, TARGET, models.Ridge("scaled"))
    test = scores.filter("dataset = 'test'").first().asDict()
    path = new_path(spark, "model")
    save_model(spark, model, FEATURES, {m: test[m] for m in ("r2", "rmse", "mae")}, path)
    loaded, manifest, _ = load_model(spark, path)
    found = serve.score(rows, loaded, manifest, "key", TARGET)
    return found.select("row_index", *[F.round(c, 0).alias(c) for c in ("predicted_salary", "actual_salary", "error")])


def compare_approaches(spark: SparkSession, folder: str) -> DataFrame:
    """Ten-fold scores of five text feature sets for one target, from one scan over all folds.

    The target is the length of a document; the vectors are the given ones where a document has one.
    """
    docs = documents(spark, folder, "text", "n_chars")
    docs, terms = tfidf.fit_field(docs, "text", "description", "A")
    words = materialize(docs.select("doc_id", X.words(X.clean_text("text")).alias("words")), "words")
    word_model = vectors.fit_word_vectors(words, "words")
    size = word_model.getVectorSize()
    pooled = vectors.pool_words(words, "doc_id", "words", vectors.vector_table(word_model), size, "w2v")
    given = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("emb"))
    joined = vectors.attach_vectors(terms.transform(docs).join(pooled, "doc_id"), given, "doc_id", "emb", 64)
    ready = joined.select(
        "doc_id", F.col("n_chars").cast("double").alias("label"),
        vectors.array_to_vector(F.concat(vectors.vector_to_array("description_tfidf"), "w2v", "emb")).alias("features"),
    )
    ready = split.with_folds(materialize(ready, "approaches"), "doc_id")
    t = len(terms.vocabulary)
    blocks = {"tfidf": range(t), "word2vec": range(t, t + size), "sentence": range(t + size, t + size + 64)}
    sets = {name: list(cols) for name, cols in blocks.items()}
    sets |= {"tfidf_word2vec": sets["tfidf"] + sets["word2vec"], "tfidf_sentence": sets["tfidf"] + sets["sentence"]}
    summary = metrics.fold_summary(crossval.cross_validate(ready, sets), ["approach", "features"])
    return importance.ranked(summary, "r2_mean", "approach", 5)


QUERIES = {
    "evaluate_ridge": evaluate_ridge,
    "ridge_model": _one_model("Ridge Regression"),
    "random_forest": _one_model("Random Forest"),
    "boosted_trees": _one_model("Boosted Trees"),
    "mlp": _one_model("MLP Neural Network"),
    "compare_models": compare_models,
    "prediction_points": prediction_points,
    "train_report": train_report,
    "top_coefficients": top_coefficients,
    "tree_importance": tree_importance,
    "permutation_importance": permutation_importance,
    "compare_importance": compare_importance,
    "evaluation_report": evaluation_report,
    "production_score": production_score,
    "save_load_score": save_load_score,
    "compare_approaches": compare_approaches,
}
SQL_ITEMS = """
rows_ AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS key, l_extendedprice AS x,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y
  FROM lineitem JOIN part ON l_partkey = p_partkey)
"""


def _sql_ridge() -> str:
    """Common table expressions of the ridge fit on all features, up to p: key, t (test row), y, z (scaled), p (prediction)."""
    n = len(FEATURES)
    values = ", ".join(
        f"CAST(l_returnflag = '{f.rsplit('_', 1)[1]}' AS INTEGER)::DOUBLE" if f.startswith("l_returnflag") else f"{f}::DOUBLE" for f in FEATURES
    )
    steps = f"""
items_ AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS key, [{values}] AS x,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS y
  FROM lineitem JOIN part ON l_partkey = p_partkey),
part_ AS (SELECT key, x, y, {sql_hash('key')} % 10000 < 2000 AS t FROM items_ WHERE y > 0),
i_ AS (SELECT unnest(range(1, {n + 1})) AS i), j_ AS (SELECT unnest(range(1, {n + 1})) AS j),
st AS (SELECT list(m ORDER BY i) AS ms, list(CASE WHEN s > 0 THEN s ELSE 1 END ORDER BY i) AS ss
  FROM (SELECT i, avg(x[i]) AS m, stddev_pop(x[i]) AS s FROM part_, i_ WHERE NOT t GROUP BY i)),
z_ AS (SELECT key, t, y, list_transform(range(1, {n + 1}), lambda i: (x[i] - ms[i]) / ss[i]) AS z FROM part_, st),
mean_ AS (SELECT avg(y) AS my FROM z_ WHERE NOT t),
gram AS (SELECT i, j, sum(z[i] * z[j]) + CASE WHEN i = j THEN 1 ELSE 0 END AS v FROM z_, i_, j_ WHERE NOT t GROUP BY i, j),
side AS (SELECT i, sum(z[i] * (y - my)) AS r FROM z_, i_, mean_ WHERE NOT t GROUP BY i),
m0 AS (SELECT gram.i, list_append(list(v ORDER BY j), any_value(r)) AS v FROM gram JOIN side ON gram.i = side.i GROUP BY gram.i),"""
    for k in range(1, n + 1):  # Gauss-Jordan elimination; the penalty keeps every pivot above zero
        steps += f"""
m{k} AS (SELECT m.i, list_transform(range(1, {n + 2}), lambda c: CASE WHEN m.i = {k} THEN q[c] / q[{k}] ELSE m.v[c] - m.v[{k}] / q[{k}] * q[c] END) AS v
  FROM m{k - 1} AS m, (SELECT v AS q FROM m{k - 1} WHERE i = {k}) AS q_),"""
    return steps + f"""
w_ AS (SELECT list(v[{n + 1}] ORDER BY i) AS w FROM m{n}),
p_ AS (SELECT key, t, y, z, w, my + list_dot_product(w, z) AS p FROM z_, w_, mean_)"""


SQL = {
    "ridge_model": f"""
WITH {_sql_ridge()},
s AS (SELECT t, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2 FROM p_ GROUP BY t)
SELECT 'Ridge Regression' AS name, round(a.rmse, 3) AS train_rmse, round(b.rmse, 3) AS test_rmse, round(a.mae, 3) AS train_mae,
  round(b.mae, 3) AS test_mae, round(a.r2, 6) AS train_r2, round(b.r2, 6) AS test_r2, round(a.r2 - b.r2, 6) AS overfitting_gap,
  CASE WHEN a.r2 - b.r2 < 0.05 THEN 'None' WHEN a.r2 - b.r2 < 0.1 THEN 'Mild' WHEN a.r2 - b.r2 < 0.2 THEN 'Moderate' ELSE 'Severe' END AS overfitting_status
FROM s a JOIN s b ON NOT a.t AND b.t""",
    "permutation_importance": f"""
WITH {_sql_ridge()},
loss AS (SELECT i, any_value(w[i]) AS c, covar_pop(y - p, z[i]) AS ez, var_pop(z[i]) AS zz, var_pop(y) AS yy FROM p_, i_ WHERE t GROUP BY i),
drops AS (SELECT i, (2 * c * ez + 2 * c * c * zz) / yy AS v FROM loss)
SELECT 'ridge' AS model, {FEATURES}[i] AS feature,
  round(CASE WHEN sum(v) OVER () > 0 THEN v / sum(v) OVER () ELSE v END, 9) AS importance FROM drops""",
    "evaluation_report": f"""
WITH {_sql_ridge()},
s AS (SELECT t, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2 FROM p_ GROUP BY t),
c AS (SELECT i <= 6 AS numeric, x[i] AS v FROM part_, i_),
q AS (SELECT numeric, round(avg(v), 6) AS m, round(stddev_pop(v), 6) AS d, round(100.0::DOUBLE * count(*) FILTER (v <> 0) / count(*), 6) AS z FROM c GROUP BY numeric)
SELECT 'ridge' AS name, round(a.rmse, 3) AS train_rmse, round(b.rmse, 3) AS test_rmse, round(a.mae, 3) AS train_mae,
  round(b.mae, 3) AS test_mae, round(a.r2, 6) AS train_r2, round(b.r2, 6) AS test_r2, round(a.r2 - b.r2, 6) AS overfitting_gap,
  CASE WHEN a.r2 - b.r2 < 0.05 THEN 'None' WHEN a.r2 - b.r2 < 0.1 THEN 'Mild' WHEN a.r2 - b.r2 < 0.2 THEN 'Moderate' ELSE 'Severe' END AS overfitting_status,
  6::INTEGER AS items_numeric_columns, n.m AS items_numeric_mean, n.d AS items_numeric_std, n.z AS items_numeric_non_zero_percent,
  3::INTEGER AS items_one_hot_columns, o.m AS items_one_hot_mean, o.d AS items_one_hot_std, o.z AS items_one_hot_non_zero_percent
FROM s a JOIN s b ON NOT a.t AND b.t JOIN q n ON n.numeric JOIN q o ON NOT o.numeric""",
    "production_score": f"""
WITH {_sql_ridge()}
SELECT key AS row_index, round(p, 0) AS predicted_salary, round(y, 0) AS actual_salary, round(abs(p - y), 0) AS error FROM p_""",
    "train_report": f"""
WITH {_sql_ridge()},
e AS (SELECT key, abs(y - p) AS e FROM p_ WHERE t),
b(label, low, high) AS (VALUES ('< $5K', 0, 5000), ('$5K - $10K', 5000, 10000), ('$10K - $20K', 10000, 20000),
  ('$20K - $50K', 20000, 50000), ('> $50K', 50000, NULL)),
r AS (SELECT *, row_number() OVER (ORDER BY e, key) AS best, row_number() OVER (ORDER BY e DESC, key) AS worst FROM e)
SELECT 'percentile' AS what, unnest([10, 25, 50, 75, 90, 95, 99])::VARCHAR AS name,
  round(unnest(quantile_cont(e, [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])), 4) AS value FROM e
UNION ALL SELECT 'bin', label, round(100.0::DOUBLE * count(e) / (SELECT count(*) FROM e), 4) FROM b LEFT JOIN e ON e >= low AND (e < high OR high IS NULL) GROUP BY label
UNION ALL SELECT 'best', key, round(e, 4) FROM r WHERE best <= 5
UNION ALL SELECT 'worst', key, round(e, 4) FROM r WHERE worst <= 5""",
    "evaluate_ridge": f"""
WITH {SQL_ITEMS},
part_ AS (SELECT x, y, {sql_hash('key')} % 10000 < 2000 AS t FROM rows_ WHERE y > 0),
fit AS (SELECT avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my,
          count(*) * covar_pop(x, y) / stddev_pop(x) / (count(*) + 1) AS w FROM part_ WHERE NOT t),
p AS (SELECT t, y, my + w * (x - mx) / sx AS p FROM part_, fit),
s AS (SELECT t, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2 FROM p GROUP BY t)
SELECT 'ridge' AS name, round(a.rmse, 3) AS train_rmse, round(b.rmse, 3) AS test_rmse, round(a.mae, 3) AS train_mae,
  round(b.mae, 3) AS test_mae, round(a.r2, 6) AS train_r2, round(b.r2, 6) AS test_r2, round(a.r2 - b.r2, 6) AS overfitting_gap,
  CASE WHEN a.r2 - b.r2 < 0.05 THEN 'None' WHEN a.r2 - b.r2 < 0.1 THEN 'Mild' WHEN a.r2 - b.r2 < 0.2 THEN 'Moderate' ELSE 'Severe' END AS overfitting_status
FROM s a JOIN s b ON NOT a.t AND b.t""",
    "save_load_score": f"""
WITH {SQL_ITEMS},
fit AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM rows_ WHERE {sql_hash('key')} % 10000 >= 2000 AND y > 0)
SELECT key AS row_index, round(a * x + b, 0) AS predicted_salary, round(y, 6) AS actual_salary,
  round(CASE WHEN y <> 0 THEN abs(a * x + b - y) END, 0) AS error
FROM rows_, fit""",
}
