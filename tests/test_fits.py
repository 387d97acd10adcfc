"""What the model queries are fitted on."""

from rowloom.operators import models
from rowloom.plans import fits
from rowloom.sources.session import materialize


def test_models_see_every_line_item_and_feature(spark, folder, monkeypatch):
    seen = []

    class Watching(models.Ridge):
        def _fit(self, dataset):
            seen.append((dataset.count(), dataset.first()["scaled"].size))
            return super()._fit(dataset)

    monkeypatch.setattr(fits, "_estimators", lambda: {"watched": lambda: Watching("scaled")})
    items = materialize(fits.items(spark, folder).filter("charge > 0"))
    train, test = fits.split.hash_split(items, "key")
    assert fits.prediction_points(spark, folder).count() == test.count()
    assert seen == [(train.count(), 9)]


def test_boosting_keeps_no_node_ids_per_level_and_fits_the_same_trees(spark):
    rows = spark.range(0, 400, 1, 2).selectExpr("CAST(id % 37 AS DOUBLE) a", "CAST(id % 11 AS DOUBLE) b", "CAST((id % 37) * (id % 11) AS DOUBLE) label")
    rows = materialize(models.assemble(rows, ["a", "b"], "scaled"))
    plain = models.boosting("scaled", trees=5)
    assert not plain.getCacheNodeIds()
    trees = [e.fit(rows).toDebugString.split("\n", 1)[1] for e in (plain, models.boosting("scaled", trees=5).setCacheNodeIds(True))]
    assert trees[0] == trees[1] and "If (feature" in trees[0]
