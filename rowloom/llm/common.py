"""What several operators share: reading tables, sizes of tasks, batches of bounded size."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import ranked  # noqa: F401


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A table by any path that Spark reads."""
    found = spark.read.parquet(f"{folder}/{name}.parquet")
    return found.select(*columns) if columns else found


def parts(spark: SparkSession) -> int:
    """Partitions of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def kept(name: str, make: Callable):
    """What a worker process keeps from task to task: one thing at a time, the last that was asked for.

    Functions travel by value, so their module's own globals are new in every task.
    """
    module = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    if getattr(module, "name", None) != name:
        module.name = module.value = None
        module.value = make()
        module.name = name
    return module.value


def give_back(cycles: bool = True) -> None:
    """Return to the system what a task's objects have taken; a worker process goes on to the next task.

    Arrays need no search for ``cycles``, which takes a tenth of a second.
    """
    if cycles:
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """A task's function that gives back its memory when its batches are through."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def crc_text(key: Column) -> Column:
    """crc32 of a number written as text; null counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` holds about ``limit`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)
