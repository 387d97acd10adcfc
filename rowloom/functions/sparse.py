"""Vectors by their stored entries: nothing here is as long as a vector, unless the vector is dense."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F

from .cells import col


def entries(vector: Column | str) -> Column:
    """(index, value) of each stored entry of a vector, as an array of structs."""
    raw = F.unwrap_udt(col(vector))
    places = F.coalesce(raw["indices"], F.transform(raw["values"], lambda _, i: i))
    return F.arrays_zip(places.alias("index"), raw["values"].alias("value"))


def sparse_vector(size: int, indices: Column | str, values: Column | str) -> Column:
    """A vector from its stored entries; indices ascend."""
    @F.arrow_udf(VectorUDT())
    def wrap(places: pa.Array, numbers: pa.Array) -> pa.Array:
        n = len(places)
        return pa.StructArray.from_arrays(
            [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), places.cast(pa.list_(pa.int32())), numbers.cast(pa.list_(pa.float64()))],
            ["type", "size", "indices", "values"],
        )

    return wrap(col(indices), col(values))


def log_scaled(vector: Column | str, weights: Sequence[float]) -> Column:
    """Every stored entry x becomes (1 + ln x) times its index's weight; entries are above 0."""
    held = np.asarray(weights, float)

    @F.arrow_udf(VectorUDT())
    def scale(vectors: pa.Array) -> pa.Array:
        parts = [vectors.field(i) for i in range(4)]
        values, places = parts[3].flatten().to_numpy(zero_copy_only=False), parts[2].flatten().to_numpy(zero_copy_only=False)
        scaled = pa.array((1.0 + np.log(values)) * held[places])
        lengths = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(parts[3]).to_numpy(zero_copy_only=False))])
        return pa.StructArray.from_arrays([*parts[:3], pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), scaled)], ["type", "size", "indices", "values"])

    return scale(col(vector))
