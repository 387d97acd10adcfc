"""Connected components of a graph of any size, as joins and aggregations.

Large-star and small-star steps (Kiveris et al., 2014) hang every node below ever smaller neighbours until
each hangs below the smallest node of its component. Smallest neighbours are found by aggregations that
combine before they shuffle; a node with very many neighbours is one row per task there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def roots(edges: DataFrame, most: int = 60) -> DataFrame:
    """(u, v): for every node but the smallest of its component, that smallest node.

    ``edges`` has two columns u and v of one orderable type; loops and repeats do no harm, an empty table
    gives an empty one. Each round is written to the shared folder, so no lineage grows.
    """
    state = materialize(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    mark = None
    for _ in range(most):
        state = materialize(_small_star(_large_star(state)), "stars")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return state
        mark = tuple(now)
    raise RuntimeError("components did not settle")
