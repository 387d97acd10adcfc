"""Splits, folds, scaling, closed-form fits, error diagnostics and importance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bands
from ..operators import crossval, importance, metrics, models, project, serve, split
from ..sources.tables import spread
from .base import SQL_PREDICTED, predicted_items, sql_hash, table

# --- splits and scaling -----------------------------------------------------


def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", split.in_test("doc_id").alias("is_test"))


def hash_split_exact(spark: SparkSession, folder: str) -> DataFrame:
    return split.exact_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


def kfold(spark: SparkSession, folder: str) -> DataFrame:
    return split.with_folds(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


def scale_population(spark: SparkSession, folder: str) -> DataFrame:
    names = ["l_quantity", "l_discount", "l_tax"]
    items = models.assemble(spread(table(spark, folder, "lineitem")).withColumn("one", F.lit(3.0)), [*names, "one"])
    scaled = models.PopulationScaler().fit(items).transform(items)
    cells = models.vector_to_array("scaled")
    return scaled.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        *[F.round(cells[i] + 0.0, 6).alias(f"{c}_scaled") for i, c in enumerate([*names, "one"])],
    )


def ols_single(spark: SparkSession, folder: str) -> DataFrame:
    items = models.assemble(spread(table(spark, folder, "lineitem")), ["l_quantity"]).withColumnRenamed("l_extendedprice", "label")
    model = models.least_squares().fit(items)
    scores = metrics.regression_metrics(model.transform(items))
    return scores.select(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 3).alias("intercept"), F.round("r2", 6).alias("r2"),
    )


RIDGE = ["l_quantity", "l_discount"]


def _ridge(spark: SparkSession, folder: str):
    names = RIDGE
    items = models.assemble(spread(table(spark, folder, "lineitem")), names).withColumnRenamed("l_extendedprice", "label")
    scaled = models.PopulationScaler().fit(items).transform(items)
    return models.Ridge("scaled", alpha=1000.0).fit(scaled)


def ridge(spark: SparkSession, folder: str) -> DataFrame:
    found = models.top_coefficients(_ridge(spark, folder), RIDGE)
    return found.select("feature", F.round("coefficient", 3).alias("coefficient"))


def top_by_value(spark: SparkSession, folder: str) -> DataFrame:
    """The largest coefficient by signed value."""
    found = models.top_coefficients(_ridge(spark, folder), RIDGE, 1, by_size=False)
    return found.select("feature", F.round("coefficient", 3).alias("coefficient"))


def linear_importance(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.linear_importance(spark, _ridge(spark, folder), RIDGE, "ridge")
    return found.select("model", "feature", F.round("importance", 6).alias("importance"))


def score_row(spark: SparkSession, folder: str) -> DataFrame:
    """One order, by position, scored by a model of its price from its key."""
    orders = table(spark, folder, "orders").withColumn("k", (F.col("o_orderkey") % 97).cast("double"))
    model, _ = serve.train(orders, "o_orderkey", ["k"], "o_totalprice", models.least_squares("scaled"))
    found = serve.score_at(orders, "o_orderkey", 42, model, ["k"], "o_totalprice", title="o_orderstatus")
    return found.select("row_index", F.round("predicted_salary", 3).alias("predicted_salary"), "actual_salary", "title")


def cross_validate(spark: SparkSession, folder: str) -> DataFrame:
    """Ten-fold least squares of an order's price, for three feature sets in one scan."""
    orders = table(spark, folder, "orders")
    rows = orders.select(
        "o_orderkey", (F.col("o_custkey") % 100).alias("c"), (F.col("o_orderkey") % 97).alias("k"),
        F.col("o_totalprice").alias("label"),
    )
    folded = split.with_folds(models.assemble(rows, ["c", "k"]), "o_orderkey")
    found = crossval.cross_validate(folded, {"c": [0], "k": [1], "both": [0, 1]})
    return found.select(
        "approach", F.col("fold").cast("bigint").alias("fold"),
        F.round("r2", 6).alias("r2"), F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"),
    )


_CV = """
SELECT '{0}' AS approach, f, regr_slope(o_totalprice, x) AS a, regr_intercept(o_totalprice, x) AS b
FROM (SELECT fold, {1} AS x, o_totalprice FROM folds) JOIN (SELECT unnest(range(1, 11)) AS f) ON f <> fold GROUP BY f"""
SQL_CV = f"""
WITH folds AS (SELECT *, ntile(10) OVER (ORDER BY o_orderkey) AS fold FROM orders),
fits AS ({_CV.format('c', 'o_custkey % 100')} UNION ALL {_CV.format('k', 'o_orderkey % 97')}),
m AS (
  SELECT f, avg(c) AS mc, avg(k) AS mk, avg(y) AS my, var_pop(c) AS cc, var_pop(k) AS kk, covar_pop(c, k) AS ck,
    covar_pop(c, y) AS cy, covar_pop(k, y) AS ky
  FROM (SELECT fold, (o_custkey % 100)::DOUBLE AS c, (o_orderkey % 97)::DOUBLE AS k, o_totalprice AS y FROM folds)
  JOIN (SELECT unnest(range(1, 11)) AS f) ON f <> fold GROUP BY f),
p AS (SELECT approach, fold, o_totalprice AS y,
        a * (CASE approach WHEN 'c' THEN o_custkey % 100 ELSE o_orderkey % 97 END) + b AS p
      FROM folds JOIN fits ON f = fold
      UNION ALL
      SELECT 'both', fold, o_totalprice,
        my + ((cy * kk - ky * ck) * (o_custkey % 100 - mc) + (ky * cc - cy * ck) * (o_orderkey % 97 - mk)) / (cc * kk - ck * ck)
      FROM folds JOIN m ON f = fold)
SELECT approach, fold, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2,
  round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae
FROM p GROUP BY approach, fold
"""

SQL_RIDGE = """WITH s AS (SELECT count(*) AS n, corr(l_quantity, l_discount) AS r,
  covar_pop(l_quantity, l_extendedprice) / stddev_pop(l_quantity) AS a, covar_pop(l_discount, l_extendedprice) / stddev_pop(l_discount) AS b
  FROM lineitem),
g AS (SELECT n + 1000.0::DOUBLE AS d, n * r AS o, n * a AS u, n * b AS v FROM s)
SELECT 'l_quantity' AS feature, round((d * u - o * v) / (d * d - o * o), 3) AS coefficient FROM g
UNION ALL SELECT 'l_discount', round((d * v - o * u) / (d * d - o * o), 3) FROM g"""

# --- error diagnostics ------------------------------------------------------


def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.regression_metrics(predicted_items(spark, folder), by=["l_returnflag"])
    return found.select("l_returnflag", *[F.round(m, 3).alias(m) for m in ("rmse", "mae", "r2", "mape")],
                        F.round(F.col("mse") / 1e6, 3).alias("mse_millions"))


def residuals(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.residuals(predicted_items(spark, folder))
    return found.select("l_orderkey", "l_linenumber", F.round("residual", 3).alias("residual"))


def error_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.error_percentiles(predicted_items(spark, folder))
    return found.select("percentile", F.round("abs_error", 4).alias("abs_error"))


def error_bins(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.error_bins(predicted_items(spark, folder))
    return found.select("bin", "label", "count", F.round("percent", 6).alias("percent"))


def best_worst(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.best_and_worst(predicted_items(spark, folder), "row")
    return found.select("kind", "rank", "row", *[F.round(c, 4).alias(c) for c in ("actual", "predicted", "abs_error")])


def _fold_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Scores per approach (here a return flag) and fold (here the order's remainder)."""
    rows = predicted_items(spark, folder).select(
        F.col("l_returnflag").alias("approach"), (F.col("l_orderkey") % 10).alias("fold"), "label", "prediction"
    )
    return metrics.regression_metrics(rows, by=["approach", "fold"])


def fold_summary(spark: SparkSession, folder: str) -> DataFrame:
    found = metrics.fold_summary(_fold_scores(spark, folder))
    return found.select("approach", *[F.round(c, 4).alias(c) for c in found.columns if c != "approach"])


def approach_gain(spark: SparkSession, folder: str) -> DataFrame:
    """Pairwise gains in mean error size (any positive score will do)."""
    scores = _fold_scores(spark, folder).withColumn("r2", F.lit(1e6) / F.col("rmse"))
    found = crossval.approach_gains(metrics.fold_summary(scores), [("A", "N"), ("N", "R"), ("A", "R")])
    return found.select("left", "right", "winner", F.round("gain_percent", 4).alias("gain_percent"))


def best_approach(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.ranked(metrics.fold_summary(_fold_scores(spark, folder)), "r2_mean", "approach", 1)
    return found.select("approach", F.round("r2_mean", 4).alias("r2_mean"), "rank")


def overfit_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = predicted_items(spark, folder).select(
        F.col("l_returnflag").alias("name"),
        F.when(split.in_test("l_orderkey"), "test").otherwise("train").alias("dataset"), "label", "prediction",
    )
    found = metrics.train_test_difference(metrics.regression_metrics(rows, by=["name", "dataset"]))
    gap = F.col("r2_difference")
    return found.select(
        "name", F.round(gap, 4).alias("r2_difference"), F.round("rmse_difference", 3).alias("rmse_difference"),
        F.round("mae_difference", 3).alias("mae_difference"),
        bands.gap_band(gap).alias("comparison"), bands.gap_band(gap, "final").alias("final"),
        bands.gap_band(gap, "production").alias("production"), bands.r2_band("test_r2").alias("fit"),
    )


def score_output(spark: SparkSession, folder: str) -> DataFrame:
    found = serve.prediction_report(_scored_orders(spark, folder))
    return found.select(
        "row_index", "predicted_salary", "actual_salary",
        F.round("error", 4).alias("error"), F.round("error_pct", 4).alias("error_pct"), "title", "company",
    )


def _scored_orders(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal", "c_mktsegment")
    k = F.col("o_orderkey")
    return table(spark, folder, "orders").join(customers, "o_custkey").select(
        k.alias("row_index"), (F.col("c_acctbal") * 50).alias("predicted"),
        F.when(k % 10 == 0, 0.0).when(k % 10 == 1, None).otherwise(F.col("o_totalprice")).alias("actual"),
        F.substring("c_name", 1, 60).alias("title"), F.substring("c_mktsegment", 1, 40).alias("company"),
    )


def mean_errors(spark: SparkSession, folder: str) -> DataFrame:
    found = serve.mean_errors(serve.prediction_report(_scored_orders(spark, folder)))
    return found.select("rows", F.round("mean_error", 4).alias("mean_error"), F.round("mean_error_pct", 4).alias("mean_error_pct"))


def manifest_align(spark: SparkSession, folder: str) -> DataFrame:
    """Event values per user against a fixed feature list that names one absent feature."""
    cells = table(spark, folder, "events").groupBy("user_id", F.col("event_type").alias("feature")).agg(
        F.max("value").alias("value")
    )
    found = serve.align_long(cells, "user_id", ["click", "purchase", "absent", "view"])
    return found.select("user_id", F.col("position").cast("bigint").alias("position"), "feature", F.round("value", 4).alias("value"))


# --- importance -------------------------------------------------------------

_FEATURES = {
    "l_quantity": "title_tfidf_quantity", "l_discount": "desc_w2v_0", "l_tax": "city_frequency",
    "l_linenumber": "country_binary", "l_suppkey": "views", "l_partkey": "company_size_M",
}


def _importance_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One importance per (return flag as model, feature): the size of the correlation with price."""
    items = table(spark, folder, "lineitem")
    wide = items.groupBy(F.col("l_returnflag").alias("model")).agg(*[
        F.abs(F.corr(F.col(c).cast("double"), F.col("l_extendedprice"))).alias(name) for c, name in _FEATURES.items()
    ])
    rows = wide.unpivot(["model"], list(_FEATURES.values()), "feature", "importance")
    return importance.with_type(importance.normalized(rows))


_LONG = " UNION ALL ".join(
    f"SELECT l_returnflag AS model, '{name}' AS feature, abs(corr({c}::DOUBLE, l_extendedprice)) AS v FROM lineitem GROUP BY 1"
    for c, name in _FEATURES.items()
)
SQL_IMPORTANCE = f"""
raw AS ({_LONG}),
imp AS (SELECT model, feature, v / sum(v) OVER (PARTITION BY model) AS importance,
  CASE feature WHEN 'title_tfidf_quantity' THEN 'TF-IDF' WHEN 'desc_w2v_0' THEN 'Word2Vec' WHEN 'city_frequency' THEN 'Frequency'
    WHEN 'country_binary' THEN 'Binary' WHEN 'views' THEN 'Other Numeric' ELSE 'One-Hot' END AS feature_type FROM raw),
types AS (SELECT model, feature_type, sum(importance) AS importance FROM imp GROUP BY ALL),
avg_types AS (SELECT feature_type, avg(importance) AS importance FROM types GROUP BY 1),
avg_feat AS (SELECT feature, feature_type, avg(importance) AS importance, count(*) AS models FROM imp GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY importance DESC, feature) AS r FROM imp)
"""


def importance_normalized(spark: SparkSession, folder: str) -> DataFrame:
    return _importance_rows(spark, folder).select("model", "feature", "feature_type", F.round("importance", 6).alias("importance"))


def type_importance(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.average_type_importance(_importance_rows(spark, folder))
    return found.select("feature_type", F.round("importance", 6).alias("importance"), F.round("percent", 4).alias("percent"))


def type_importance_by_model(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.type_importance(_importance_rows(spark, folder))
    return found.select("model", "feature_type", F.round("importance", 6).alias("importance"))


def avg_importance(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.top_features(_importance_rows(spark, folder))
    return found.select("rank", "feature", "feature_type", F.round("importance", 6).alias("importance"), "models")


def top_per_model(spark: SparkSession, folder: str) -> DataFrame:
    return importance.top_per_model(_importance_rows(spark, folder), 3).select("model", "feature", "rank")


def consistent_features(spark: SparkSession, folder: str) -> DataFrame:
    return importance.consistent_features(_importance_rows(spark, folder), 3)


def importance_matrix(spark: SparkSession, folder: str) -> DataFrame:
    types = ["TF-IDF", "Word2Vec", "Frequency", "Binary", "Other Numeric", "One-Hot", "Ordinal"]
    found = importance.importance_matrix(_importance_rows(spark, folder), types)
    return found.select("model", *[F.round(f"`{t}`", 6).alias(t) for t in types])


def main_type(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.main_type(_importance_rows(spark, folder))
    return found.select("model", "feature_type", F.round("importance", 6).alias("importance"))


def recommendations(spark: SparkSession, folder: str) -> DataFrame:
    found = importance.recommendations(_importance_rows(spark, folder))
    return found.select("rule", "subject", F.round("value", 6).alias("value"))


def model_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Union of per-model score tables, numbered best first."""
    rows = predicted_items(spark, folder)
    parts = [
        metrics.regression_metrics(rows.withColumn("prediction", F.col("prediction") * scale)).select(
            F.lit(name).alias("name"), "r2"
        )
        for name, scale in (("plain", 1.0), ("double", 2.0), ("low", 0.5))
    ]
    found = importance.ranked(importance.union_all(parts), "r2", "name", 10)
    return found.select("rank", "name", F.round("r2", 4).alias("r2"))


def sample_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of the return flags that have enough rows to be modelled."""
    items = table(spark, folder, "lineitem")
    flags = [f for f in ("A", "N", "R", "X") if project.enough_rows(items.filter(F.col("l_returnflag") == f))]
    return items.filter(F.col("l_returnflag").isin(flags)).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "hash_split": hash_split,
    "hash_split_exact": hash_split_exact,
    "kfold": kfold,
    "scale_population": scale_population,
    "ols_single": ols_single,
    "ridge": ridge,
    "top_by_value": top_by_value,
    "linear_importance": linear_importance,
    "score_row": score_row,
    "cross_validate": cross_validate,
    "regression_metrics": regression_metrics,
    "residuals": residuals,
    "error_percentiles": error_percentiles,
    "error_bins": error_bins,
    "best_worst": best_worst,
    "fold_summary": fold_summary,
    "approach_gain": approach_gain,
    "best_approach": best_approach,
    "overfit_status": overfit_status,
    "score_output": score_output,
    "mean_errors": mean_errors,
    "manifest_align": manifest_align,
    "importance_normalized": importance_normalized,
    "type_importance": type_importance,
    "type_importance_by_model": type_importance_by_model,
    "avg_importance": avg_importance,
    "top_per_model": top_per_model,
    "consistent_features": consistent_features,
    "importance_matrix": importance_matrix,
    "main_type": main_type,
    "recommendations": recommendations,
    "model_ranking": model_ranking,
    "sample_guard": sample_guard,
}

_SCORES = "1 - avg((y - p) * (y - p)) / var_pop(y) AS r2, sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae"
_FOLDS = f"scores AS (SELECT l_returnflag AS approach, l_orderkey % 10 AS fold, {_SCORES} FROM ({SQL_PREDICTED}) GROUP BY ALL)"
SQL = {
    "hash_split": f"SELECT doc_id, {sql_hash('doc_id')} % 10000 < 2000 AS is_test FROM documents",
    "hash_split_exact": f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {sql_hash('o_orderkey', 15)}, o_orderkey) AS i, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, i <= ceil(n / 5.0::DOUBLE) AS is_test FROM r""",
    "kfold": "SELECT o_orderkey, ntile(10) OVER (ORDER BY o_orderkey)::INTEGER AS fold FROM orders",
    "scale_population": """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd,
  avg(l_tax) AS mt, stddev_pop(l_tax) AS st FROM lineitem)
SELECT l_orderkey, l_partkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity_scaled,
  round((l_discount - md) / sd, 6) AS l_discount_scaled, round((l_tax - mt) / st, 6) AS l_tax_scaled, 0.0::DOUBLE AS one_scaled
FROM lineitem, s""",
    "ols_single": """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""",
    "ridge": SQL_RIDGE,
    "top_by_value": f"SELECT * FROM ({SQL_RIDGE}) ORDER BY coefficient DESC, feature LIMIT 1",
    "linear_importance": f"""
SELECT 'ridge' AS model, feature, round(abs(c) / sum(abs(c)) OVER (), 6) AS importance
FROM ({SQL_RIDGE.replace(', 3)', ', 15)').replace('AS coefficient', 'AS c')})""",
    "score_row": f"""
WITH fit AS (
  SELECT regr_slope(o_totalprice, o_orderkey % 97) AS a, regr_intercept(o_totalprice, o_orderkey % 97) AS b
  FROM orders WHERE {sql_hash("o_orderkey::VARCHAR")} % 10000 >= 2000 AND o_totalprice > 0)
SELECT o_orderkey AS row_index, round(a * (o_orderkey % 97) + b, 3) AS predicted_salary, o_totalprice AS actual_salary, o_orderstatus AS title
FROM (SELECT * FROM orders ORDER BY o_orderkey OFFSET 42 LIMIT 1), fit""",
    "cross_validate": SQL_CV,
    "regression_metrics": f"""
SELECT l_returnflag, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae,
  round(1 - avg((y - p) * (y - p)) / var_pop(y), 3) AS r2, round(100 * avg(abs((y - p) / y)), 3) AS mape,
  round(avg((y - p) * (y - p)) / 1e6, 3) AS mse_millions
FROM ({SQL_PREDICTED}) GROUP BY 1""",
    "residuals": f"SELECT l_orderkey, l_linenumber, round(y - p, 3) AS residual FROM ({SQL_PREDICTED})",
    "error_percentiles": "WITH e AS (SELECT abs(y - p) AS e FROM (" + SQL_PREDICTED + """))
SELECT unnest([10, 25, 50, 75, 90, 95, 99])::INTEGER AS percentile,
  round(unnest(quantile_cont(e, [0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])), 4) AS abs_error FROM e""",
    "error_bins": f"""
WITH e AS (SELECT abs(y - p) AS e FROM ({SQL_PREDICTED})),
b(bin, label, low, high) AS (VALUES (1, '< $5K', 0, 5000), (2, '$5K - $10K', 5000, 10000), (3, '$10K - $20K', 10000, 20000),
  (4, '$20K - $50K', 20000, 50000), (5, '> $50K', 50000, NULL))
SELECT bin, label, count(e) AS count, round(100.0::DOUBLE * count(e) / (SELECT count(*) FROM e), 6) AS percent
FROM b LEFT JOIN e ON e >= low AND (e < high OR high IS NULL) GROUP BY bin, label""",
    "best_worst": f"""
WITH e AS (SELECT row_, y, p, abs(y - p) AS e FROM ({SQL_PREDICTED})),
r AS (SELECT *, row_number() OVER (ORDER BY e, row_) AS b, row_number() OVER (ORDER BY e DESC, row_) AS w FROM e)
SELECT 'best' AS kind, b::INTEGER AS rank, row_ AS row, round(y, 4) AS actual, round(p, 4) AS predicted, round(e, 4) AS abs_error FROM r WHERE b <= 5
UNION ALL SELECT 'worst', w::INTEGER, row_, round(y, 4), round(p, 4), round(e, 4) FROM r WHERE w <= 5""",
    "fold_summary": f"""
WITH {_FOLDS} SELECT approach, round(avg(r2), 4) AS r2_mean, round(stddev_pop(r2), 4) AS r2_std, round(avg(rmse), 4) AS rmse_mean,
  round(stddev_pop(rmse), 4) AS rmse_std, round(avg(mae), 4) AS mae_mean, round(stddev_pop(mae), 4) AS mae_std
FROM scores GROUP BY approach""",
    "approach_gain": f"""
WITH {_FOLDS}, m AS (SELECT approach, avg(1e6 / rmse) AS v FROM scores GROUP BY 1)
SELECT l.approach AS "left", r.approach AS "right", CASE WHEN l.v > r.v THEN l.approach ELSE r.approach END AS winner,
  round(CASE WHEN l.v > r.v THEN (l.v - r.v) / r.v ELSE (r.v - l.v) / l.v END * 100, 4) AS gain_percent
FROM m l JOIN m r ON l.approach < r.approach""",
    "best_approach": f"""
WITH {_FOLDS} SELECT approach, round(avg(r2), 4) AS r2_mean, 1::INTEGER AS rank FROM scores GROUP BY 1 ORDER BY avg(r2) DESC, approach LIMIT 1""",
    "overfit_status": f"""
WITH s AS (SELECT l_returnflag AS name, {sql_hash('l_orderkey')} % 10000 < 2000 AS t, {_SCORES} FROM ({SQL_PREDICTED}) GROUP BY ALL),
d AS (SELECT a.name, a.r2 - b.r2 AS g, a.rmse - b.rmse AS r, a.mae - b.mae AS m, b.r2 AS test FROM s a JOIN s b ON a.name = b.name AND NOT a.t AND b.t)
SELECT name, round(g, 4) AS r2_difference, round(r, 3) AS rmse_difference, round(m, 3) AS mae_difference,
  CASE WHEN g < 0.05 THEN 'None' WHEN g < 0.1 THEN 'Mild' WHEN g < 0.2 THEN 'Moderate' ELSE 'Severe' END AS comparison,
  CASE WHEN g < 0.01 THEN 'EXCELLENT' WHEN g < 0.05 THEN 'GOOD' WHEN g < 0.1 THEN 'MODERATE' ELSE 'SIGNIFICANT' END AS final,
  CASE WHEN g < 0.05 THEN 'none' WHEN g < 0.15 THEN 'moderate' ELSE 'significant' END AS production,
  CASE WHEN test >= 0.7 THEN 'EXCELLENT' WHEN test >= 0.5 THEN 'GOOD' WHEN test >= 0.3 THEN 'MODERATE' ELSE 'POOR' END AS fit FROM d""",
    "manifest_align": """
WITH c AS (SELECT user_id, event_type, max(value) AS v FROM events GROUP BY ALL),
m(position, feature) AS (VALUES (0::BIGINT, 'click'), (1, 'purchase'), (2, 'absent'), (3, 'view'))
SELECT u.user_id, m.position, m.feature, round(coalesce(v, 0), 4) AS value
FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN m LEFT JOIN c ON c.user_id = u.user_id AND c.event_type = m.feature""",
    "importance_normalized": f"WITH {SQL_IMPORTANCE} SELECT model, feature, feature_type, round(importance, 6) AS importance FROM imp",
    "type_importance": f"""
WITH {SQL_IMPORTANCE} SELECT feature_type, round(importance, 6) AS importance, round(100 * importance / sum(importance) OVER (), 4) AS percent FROM avg_types""",
    "type_importance_by_model": f"WITH {SQL_IMPORTANCE} SELECT model, feature_type, round(importance, 6) AS importance FROM types",
    "avg_importance": f"""
WITH {SQL_IMPORTANCE} SELECT row_number() OVER (ORDER BY importance DESC, feature)::INTEGER AS rank, feature, feature_type,
  round(importance, 6) AS importance, models FROM avg_feat""",
    "top_per_model": f"WITH {SQL_IMPORTANCE} SELECT model, feature, r::INTEGER AS rank FROM top WHERE r <= 3",
    "consistent_features": f"WITH {SQL_IMPORTANCE} SELECT feature, count(*) AS models FROM top WHERE r <= 3 GROUP BY 1 HAVING count(*) >= 2",
    "importance_matrix": f"""
WITH {SQL_IMPORTANCE} SELECT model, """ + ", ".join(
        f"round(coalesce(sum(importance) FILTER (feature_type = '{t}'), 0), 6) AS \"{t}\""
        for t in ("TF-IDF", "Word2Vec", "Frequency", "Binary", "Other Numeric", "One-Hot", "Ordinal")
    ) + " FROM types GROUP BY model",
    "main_type": f"""
WITH {SQL_IMPORTANCE} SELECT model, first(feature_type ORDER BY importance DESC, feature_type DESC) AS feature_type,
  round(max(importance), 6) AS importance FROM types GROUP BY model""",
    "recommendations": f"""
WITH {SQL_IMPORTANCE},
cons AS (SELECT feature, count(*) AS n FROM top WHERE r <= 20 GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, feature LIMIT 5),
best AS (SELECT * FROM avg_types ORDER BY importance DESC, feature_type LIMIT 1),
worst AS (SELECT * FROM avg_types ORDER BY importance, feature_type DESC LIMIT 1),
lead AS (SELECT * FROM avg_feat ORDER BY importance DESC, feature LIMIT 10)
SELECT 'top_type' AS rule, feature_type AS subject, round(importance, 6) AS value FROM best
UNION ALL SELECT 'remove_type', feature_type, round(importance, 6) FROM worst WHERE importance < 0.01
UNION ALL SELECT 'top_feature', feature, round(importance, 6) FROM lead
UNION ALL SELECT 'consistent_feature', feature, n FROM cons
UNION ALL SELECT 'main_type_of_model', model, round(max(importance), 6) FROM types GROUP BY model
UNION ALL SELECT 'strong_type', feature_type, round(importance, 6) FROM avg_types
  WHERE importance > CASE feature_type WHEN 'TF-IDF' THEN 0.2 WHEN 'Word2Vec' THEN 0.2 WHEN 'One-Hot' THEN 0.15 ELSE 9 END""",
    "model_ranking": "WITH s AS (" + " UNION ALL ".join(
        f"SELECT '{name}' AS name, 1 - avg((y - {f} * p) * (y - {f} * p)) / var_pop(y) AS r2 FROM ({SQL_PREDICTED})"
        for name, f in (("plain", "1.0::DOUBLE"), ("double", "2.0::DOUBLE"), ("low", "0.5::DOUBLE"))
    ) + ") SELECT row_number() OVER (ORDER BY r2 DESC, name)::INTEGER AS rank, name, round(r2, 4) AS r2 FROM s",
    "sample_guard": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 100",
}
_SCORED = """
SELECT o_orderkey AS row_index, c_acctbal * 50 AS p,
  CASE o_orderkey % 10 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN NULL ELSE o_totalprice END AS a, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey"""
SQL["score_output"] = f"""
SELECT row_index, p AS predicted_salary, a AS actual_salary, round(CASE WHEN a <> 0 THEN abs(p - a) END, 4) AS error,
  round(CASE WHEN a <> 0 THEN abs((p - a) / a * 100) END, 4) AS error_pct, c_name AS title, c_mktsegment AS company FROM ({_SCORED})"""
SQL["mean_errors"] = f"""
SELECT count(*) FILTER (a <> 0) AS rows, round(avg(abs(p - a)) FILTER (a <> 0), 4) AS mean_error,
  round(avg(abs((p - a) / a * 100)) FILTER (a <> 0), 4) AS mean_error_pct FROM ({_SCORED})"""
