"""Sums of vectors over a frame's partitions, for learners that add up gradients."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Parts in which vectors are added up.
SLICES = 4
_SELF = __import__(__name__, fromlist=["_"])


def sum_vectors(df: DataFrame, partial: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None]) -> np.ndarray | None:
    """Sum of ``partial(batches)`` over all partitions, combined on the executors.

    ``partial`` gives one vector of doubles for a partition's Arrow batches, or
    None where it has no rows; the result is None if all do.  The sum is made in
    ``SLICES`` parts, so the driver gets one vector, whatever the partitions.
    """
    def one(batches):
        v = partial(batches)
        if v is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v, np.float64).tobytes()], pa.binary())], ["v"])

    return sum_slices(df.mapInArrow(one, "v binary").rdd.map(lambda r: np.frombuffer(r["v"], np.float64)))


def sum_slices(vectors) -> np.ndarray | None:
    """Sum of an RDD of equally long vectors, each part of it added up in one task."""
    parts = vectors.flatMap(lambda v: enumerate(np.array_split(v, SLICES))).reduceByKey(_add, SLICES).collect()
    return np.concatenate([v for _, v in sorted(parts, key=lambda p: p[0])]) if parts else None


def _add(a, b):
    return a + b


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as a matrix, without Python objects."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


# executor code of this module travels by value (see session.ship_by_value)
from classbench.session import ship_by_value as _ship  # noqa: E402

_ship(_SELF)
