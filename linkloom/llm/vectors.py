"""What the operators on embeddings share: usable vectors, matrices of Arrow lists, sums of matrices over tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import map_batches

WIDTH = 64  # columns of a row in which a part of a matrix travels


def usable(vector: Column, below: float = float("inf")) -> Column:
    """True for a vector (array of double) of one component or more, all of them present and smaller than ``below``."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(below)))
    return F.coalesce((F.size(vector) > 0) & fits, F.lit(False))


def matrix(column: pa.Array, dims: int, dtype: type = np.float64) -> np.ndarray:
    """(rows, dims) of a column of lists; shorter lists end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), dtype)
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def add_up(df: DataFrame, shape: tuple[int, int], part: Callable[[pa.RecordBatch], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum of ``part(batch)`` over all batches, a matrix of ``shape``; ``kind`` is double or long.

    A task adds its own batches up; Spark adds the tasks' matrices up in rows of ``WIDTH`` columns, so the driver
    gets one matrix, whatever the number of tasks.
    """
    rows, columns = shape
    chunks = -(-columns // WIDTH)
    names = [f"c{k}" for k in range(min(WIDTH, columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros((rows, chunks * len(names)), np.float64 if kind == "double" else np.int64)
        any_rows = False
        for batch in batches:
            if batch.num_rows:
                any_rows = True
                total[:, :columns] += part(batch)
        if any_rows:
            cut = total.reshape(rows * chunks, len(names))
            yield {"place": list(range(rows * chunks)), **{name: cut[:, k] for k, name in enumerate(names)}}

    parts = map_batches(df, run, ", ".join(["place int", *[f"{name} {kind}" for name in names]]))
    found = parts.groupBy("place").agg(*[F.sum(name).alias(name) for name in names]).collect()
    out = np.zeros((rows * chunks, len(names)), np.float64 if kind == "double" else np.int64)
    for row in found:
        out[row["place"]] = row[1:]
    return out.reshape(rows, chunks * len(names))[:, :columns]
