"""Where jobs may put shared files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one below the session's warehouse."""
    context = spark.sparkContext
    folder = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared folder, until ``release``."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


_written: list[str] = []
_tables: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete what this driver has put into the shared folder; call it when no result is read any more."""
    paths, jvm = list(_written), spark.sparkContext._jvm
    for table in _tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    _tables.clear()
    _written.clear()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def new_table(path: str) -> str:
    """A name in the catalog for a table at a fresh path, until ``release``."""
    _tables.append("rowloom_" + path.rsplit("-", 1)[1])
    return _tables[-1]


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table that several later jobs read, and return the written table.

    Unlike a cached table it survives the loss of an executor, and it starts a fresh lineage.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
