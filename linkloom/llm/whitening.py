"""Whitening of embeddings on whole-number vectors, each different vector once.

Equal vectors are grouped; a group's weight in the fit is its count or one. Sums are exact whole numbers, the
covariance is a weighted product of centred rows, added up over tasks. Every different vector is whitened once and joined
back to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import broadcast_value, map_batches, named
from linkloom.llm.vectors import add_up, matrix, usable
from linkloom.session import settle

SCALE, OFFSET = 64, 1_000_000
LARGEST = 2.0 ** 25  # entries from here on count as not finite: below, all sums and products of a fit are exact
RANK = 1e-12  # a component explains more than this part of the variance


@dataclass(frozen=True)
class Fit:
    """``n`` weights and per-dimension sums of the fit list, its components (rows), their variances and the trace."""

    n: int
    sums: np.ndarray  # of x - OFFSET, exact
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n


def whole(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``id`` and ``x`` (array of long) of the rows whose vector is usable: x = floor(64 c) + 1000000.

    Where lengths differ, only vectors of the most frequent length (the longest among equals) can share a
    covariance; the others go.
    """
    rows = df.select(named(id_column).alias("id"), named(vector_column).cast("array<double>").alias("v"))
    rows = rows.where(usable(F.col("v"), LARGEST))
    usual = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    rows = rows.where(F.size("v") == (usual["dims"] if usual else 0))
    return rows.select("id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(OFFSET).cast("long")).alias("x"))


def distinct(rows: DataFrame) -> DataFrame:
    """Each different ``x`` with its ``count``."""
    return settle(rows.groupBy("x").agg(F.count(F.lit(1)).alias("count")), "different-vectors")


def fit(vectors: DataFrame, components: int = 16, weight: str = "one") -> Fit | None:
    """Mean, principal components and variances of ``distinct`` vectors; None without any.

    ``weight`` is ``one`` (each different vector once) or ``count`` (as often as it occurs). Components that explain
    next to nothing have no whitened form and are left out, so there may be fewer.
    """
    if weight not in ("one", "count"):
        raise ValueError("the weight is 'one' or 'count'")
    source = vectors.select("x", (F.lit(1) if weight == "one" else F.col("count")).cast("long").alias("w"))
    size = vectors.agg(F.max(F.size("x"))).first()[0]
    if size is None:
        return None

    def plain_sums(batch: pa.RecordBatch) -> np.ndarray:
        x, w = matrix(batch.column(0), size, np.int64) - OFFSET, batch.column(1).to_numpy()
        return np.append((x * w[:, None]).sum(axis=0), w.sum())[None, :]

    total = add_up(source, (1, size + 1), plain_sums, "long")[0]
    n, sums = int(total[-1]), total[:-1]
    mean = sums / n

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        x = (matrix(batch.column(0), size, np.int64) - OFFSET) - mean
        return (x * batch.column(1).to_numpy()[:, None]).T @ x

    covariance = add_up(source, (size, size), centred) / n
    variances, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    order = [k for k in np.argsort(-variances, kind="stable") if variances[k] > RANK * trace][:components]
    return Fit(n, sums, axes[:, order].T, variances[order], trace)


def exact_deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Sum over dimensions of (n x - sums) squared, as whole numbers of any size."""
    off = n * x - sums
    if len(off) and int(np.abs(off).max()) ** 2 * off.shape[1] >= 2 ** 63:
        off = off.astype(object)
    return [int(d) for d in (off * off).sum(axis=1)]


def whitened(vectors: DataFrame, fitted: Fit) -> DataFrame:
    """``x``, ``deviation`` (decimal) and ``whitened`` (array of double) of each different vector."""
    given = broadcast_value(vectors, fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = given.value
        turn = model.components.T / np.sqrt(model.variances)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0), len(model.sums), np.int64) - OFFSET
            white = (x - model.mean) @ turn
            ends = np.arange(0, white.size + 1, white.shape[1], dtype=np.int32) if white.size else np.zeros(len(x) + 1, np.int32)
            yield {"x": batch.column(0), "deviation": [Decimal(d) for d in exact_deviations(x, model.n, model.sums)],
                   "whitened": pa.ListArray.from_arrays(ends, np.ascontiguousarray(white).ravel())}

    return settle(map_batches(vectors.select("x"), run, "x array<long>, deviation decimal(38,0), whitened array<double>"), "whitened")


def identity_error(vectors: DataFrame, white: DataFrame, fitted: Fit, weight: str = "one") -> float:
    """The largest absolute entry of the whitened vectors' weighted covariance minus the identity."""
    size = len(fitted.variances)
    if not size:
        return 0.0
    source = white.select("whitened", F.lit(1).cast("long").alias("w")) if weight == "one" else \
        white.join(vectors, "x").select("whitened", F.col("count").alias("w"))

    def weighted(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return matrix(batch.column(0), size), batch.column(1).to_numpy()[:, None]

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        rows, w = weighted(batch)
        return (rows * w).sum(axis=0)[None, :]

    mean = add_up(source, (1, size), sums)[0] / fitted.n

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        rows, w = weighted(batch)
        return ((rows - mean) * w).T @ (rows - mean)

    covariance = add_up(source, (size, size), centred) / fitted.n
    return float(np.abs(covariance - np.eye(size)).max())


def whiten(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = 16,
           weight: str = "one") -> DataFrame:
    """``id``, ``n``, ``deviation`` (decimal), ``whitened`` and ``explained`` (arrays by component), ``identity_error`` by row.

    Rows whose vector is null, empty, holds a null or non-finite entry or one of 2^25 and more, or has not the table's
    usual length are dropped. Components are numbered by falling variance; their sign is the same for all rows.
    Where the vectors span fewer dimensions than ``components``, there are fewer (none for a single different
    vector: the arrays are empty). Rows may repeat, ids may be null; other columns are not read; an empty table gives an
    empty one.
    """
    rows = whole(df, id_column, vector_column)
    vectors = distinct(rows)
    model = fit(vectors, components, weight)
    if model is None:
        empty = "id {}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
        return df.sparkSession.createDataFrame([], empty.format(rows.schema["id"].dataType.simpleString()))
    white = whitened(vectors, model)
    error = identity_error(vectors, white, model, weight)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.variances]).cast("array<double>")
    return rows.join(white, "x").select(
        "id", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
        F.lit(error).alias("identity_error"))
