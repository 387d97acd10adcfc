"""The forest against itself, however its rows are cut and wherever its nodes are grown."""

import numpy as np
import pytest

from rowloom.operators import models
from rowloom.operators.forest import ForestModel
from rowloom.sources.session import materialize, new_path


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(0, 3000, 1, 3).selectExpr(
        "CAST(id % 101 AS DOUBLE) a", "CAST(id * 7 % 89 AS DOUBLE) b", "CAST((id % 101) * (id * 7 % 89) + id % 5 AS DOUBLE) label")
    return materialize(models.assemble(rows, ["a", "b"], "scaled"))


def same(one, other):
    return len(one.trees) == len(other.trees) and all(np.array_equal(a, b) for t, u in zip(one.trees, other.trees) for a, b in zip(t, u))


def test_trees_do_not_depend_on_how_the_table_is_cut(table):
    fits = [models.forest("scaled", trees=3, depth=6).fit(rows) for rows in (table, table.repartition(7), table.repartition(2, "b"))]
    assert same(fits[0], fits[1]) and same(fits[0], fits[2]) and fits[0].totalNumNodes > 100


@pytest.mark.parametrize("most", [1, 150, 1500])
def test_nodes_split_by_histograms_are_those_that_one_task_grows(spark, table, most):
    whole, parts = (models.forest("scaled", trees=2, depth=6, nodeRows=n).setBootstrap(False).fit(table) for n in (10_000, most))
    assert parts.totalNumNodes == whole.totalNumNodes > 50
    assert parts.importances == pytest.approx(whole.importances)
    both = parts.transform(whole.transform(table).withColumnRenamed("prediction", "w")).select("w", "prediction").toPandas()
    assert both["prediction"].to_numpy() == pytest.approx(both["w"].to_numpy())


def test_large_nodes_of_a_drawn_tree_are_grown_in_batches(spark, table, monkeypatch):
    from rowloom.operators import forest as module

    whole = models.forest("scaled", trees=4, depth=8, nodeRows=400).fit(table)
    monkeypatch.setattr(module, "_BATCH_BYTES", 1)
    assert same(whole, models.forest("scaled", trees=4, depth=8, nodeRows=400).fit(table))


def test_repeated_rows_count_as_often_as_they_come(spark):
    rows = [(0.0, 1.0)] * 900 + [(0.0, 4.0)] * 100 + [(1.0, 7.0)] + [(2.0, 9.0)] * 2
    df = models.assemble(spark.createDataFrame(rows, "a DOUBLE, label DOUBLE"), ["a"])
    plain = models.forest("features", trees=1, depth=3).setBootstrap(False).fit(df)
    found = {r["a"]: r["prediction"] for r in plain.transform(df).select("a", "prediction").distinct().collect()}
    assert found == pytest.approx({0.0: 1.3, 1.0: 25 / 3, 2.0: 25 / 3})
    drawn = models.forest("features", trees=200, depth=0).fit(df)
    mean = np.mean([y for _, y in rows])
    means = np.array([t[3][0] for t in drawn.trees])
    assert means.mean() == pytest.approx(mean, abs=0.02) and means.std() == pytest.approx(np.std([y for _, y in rows]) / len(rows) ** 0.5, rel=0.25)


def test_a_saved_forest_predicts_the_same(spark, table):
    model = models.forest("scaled", trees=3, depth=5).fit(table)
    path = new_path(spark, "model")
    model.write().save(path)
    loaded = ForestModel.load(path)
    assert same(model, loaded) and loaded.featureImportances == model.featureImportances
    both = loaded.transform(model.transform(table).withColumnRenamed("prediction", "w"))
    assert both.filter("prediction <> w").count() == 0


def test_rows_that_cannot_be_trained_on_are_refused(spark, table):
    with pytest.raises(ValueError, match="no rows to train on"):
        models.forest("scaled").fit(table.filter("false"))
    for bad in ("CAST(NULL AS DOUBLE)", "CAST('NaN' AS DOUBLE)", "CAST('Infinity' AS DOUBLE)"):
        with pytest.raises(ValueError, match="finite numbers"):
            models.forest("scaled", trees=1, depth=1).fit(table.withColumn("label", models.F.expr(f"IF(a = 3, {bad}, label)")))


def test_thresholds_are_exact_ranks_however_many_values_there_are(spark, table, monkeypatch):
    from rowloom.operators import forest as module

    rows = table.selectExpr("array(a, b, a % 3) x")
    counted = module._cuts(rows, 32)
    monkeypatch.setattr(module, "_FEW_VALUES", 2)
    sought = module._cuts(rows.repartition(5), 32)
    a = np.sort([r["x"][0] for r in rows.collect()])
    assert counted[0] == pytest.approx(np.unique([a[3000 * i // 32] for i in range(1, 32)])) and counted[2] == pytest.approx([0.5, 1.5])
    assert all(np.array_equal(counted[i], sought[i]) for i in (0, 1)) and 2 in sought
