"""Dense numbers for the rows of a table of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.session import materialize


def ranked(rows: DataFrame, tree: Column, order: list[Column]) -> DataFrame:
    """The rows with ``tree``, ``rank`` (dense from 0 within the tree, in ``order``) and ``n`` (the tree's rows).

    Rows are sorted once by ranges of tree and order and written with their place in their range; a table of
    one row per range and tree then says how many rows of the tree come before. Ties end by the row's place
    in the scan, so even a table of equal rows is dealt over all ranges.
    """
    spark = rows.sparkSession
    place = F.monotonically_increasing_id()
    keyed = rows.withColumn("tree", tree).withColumn("_scan", place)
    keys = [F.col("tree").asc_nulls_first(), *order, F.col("_scan").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_scan")
    dealt = materialize(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_at", place), "ranked")
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(
            F.col("tree").alias("_tree"), F.col("_part").alias("_p"), F.sum("_rows").over(of_tree).alias("n"),
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        )
    )
    return (
        dealt.join(starts, (F.col("_part") == F.col("_p")) & F.col("tree").eqNullSafe(F.col("_tree")))
        .withColumn("rank", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_p", "_tree", "_shift")
    )
