"""Near duplicates among embeddings: tiles compared in the order of principal components.

Vectors are made unit and turned onto the principal axes of all vectors, which changes no inner product but puts the
dimensions that differ most first. A tile of vectors against another adds up the leading dimensions of all its
products; what the others can still add is at most the product of the two suffix norms, so pairs, and mostly
whole tiles, stop as soon as their cosine cannot reach the threshold. What is left is decided by the cosine
of the vectors themselves.

Which tiles meet is decided by Spark: rows of one label are dealt out in parts by the sides of the leading axes on
which they lie, large cells by number, and parts whose boxes are too far apart never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import broadcast_value, map_batches, named
from linkloom.llm.simhash import components
from linkloom.llm.vectors import add_up, matrix, usable
from linkloom.session import settle

SLACK = 1e-9  # for the rounding of partial sums; what it lets through is decided by the cosine itself
LEADING = 8  # axes of which a part's box is kept, and those the first step of a comparison adds up
TILE = (512, 2048)
MOST_AXES = 20  # sides of so many axes make cells; larger cells are dealt out by number


def unit(vectors: np.ndarray) -> np.ndarray:
    """The vectors scaled to length one, without overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(vertices: DataFrame, count: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean of the unit vectors of ``vector``, and the axes (columns) of their covariance by falling variance."""
    def moments(batch: pa.RecordBatch) -> np.ndarray:
        units = unit(matrix(batch.column(0), dims))
        return np.vstack([units.sum(axis=0), units.T @ units])

    sums = add_up(vertices.select("vector"), (dims + 1, dims), moments)
    mean = sums[0] / max(count, 1)
    _, axes = np.linalg.eigh(sums[1:] / max(count, 1) - np.outer(mean, mean))
    return mean, np.ascontiguousarray(axes[:, ::-1])


class Turned:
    """Unit vectors, the same turned onto the axes, and their suffix norms after each step of a comparison."""

    def __init__(self, vectors: np.ndarray, axes: np.ndarray):
        self.units = unit(vectors)
        self.turned = self.units @ axes
        dims = axes.shape[0]
        self.steps = sorted({min(dims, s) for s in (LEADING, 2 * LEADING, 4 * LEADING, dims)})
        tail = np.cumsum((self.turned ** 2)[:, ::-1], axis=1)[:, ::-1]
        self.suffix = {s: np.sqrt(tail[:, s]) if s < dims else np.zeros(len(vectors)) for s in self.steps}


def near_pairs(a: Turned, rows: slice, b: Turned, columns: slice, threshold: float,
               skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) numbers within the tile of the pairs with cosine ``threshold`` or more.

    ``skip`` marks pairs that are not asked for.
    """
    ta, tb = a.turned[rows], b.turned[columns]
    least, first = threshold - SLACK, a.steps[0]
    partial = ta[:, :first] @ tb[:, :first].T
    alive = partial + np.outer(a.suffix[first][rows], b.suffix[first][columns]) >= least
    if skip is not None:
        alive &= ~skip
    left = np.count_nonzero(alive)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)  # the tile is abandoned
    if left * 16 > alive.size:  # many are left: the rest as one product
        close = alive & (a.units[rows] @ b.units[columns].T >= threshold)
        return np.nonzero(close)
    i, j = np.nonzero(alive)
    partial = partial[i, j]
    for before, step in zip(a.steps, a.steps[1:]):
        partial = partial + np.einsum("ij,ij->i", ta[i, before:step], tb[j, before:step])
        kept = partial + a.suffix[step][rows][i] * b.suffix[step][columns][j] >= least
        i, j, partial = i[kept], j[kept], partial[kept]
    close = np.einsum("ij,ij->i", a.units[rows][i], b.units[columns][j]) >= threshold
    return i[close], j[close]


class Links:
    """Links found in one cell: the weight of each member's partners, and a forest of what is linked."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.found = np.zeros(len(weights), np.int64)
        self.root = np.arange(len(weights))

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        # sums of weights stay below 2^53, so the doubles of bincount are exact
        self.found += np.bincount(i, self.weights[j], len(self.root)).astype(np.int64)
        self.found += np.bincount(j, self.weights[i], len(self.root)).astype(np.int64)
        while True:
            x, y = self.root[i], self.root[j]
            apart = x != y
            if not apart.any():
                return
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def compare(members: Turned, side: np.ndarray, weights: np.ndarray, threshold: float) -> Links:
    """All links of one cell: across the two sides, or among its members where there is one side only.

    ``side`` is sorted.
    """
    links, n = Links(weights), len(side)
    second = int(np.searchsorted(side, 1))
    alone = second in (0, n)
    for top in range(0, n if alone else second, TILE[0]):
        rows = slice(top, min(top + TILE[0], n if alone else second))
        for left in range(top if alone else second, n, TILE[1]):
            columns = slice(left, min(left + TILE[1], n))
            skip = None
            if alone and columns.start < rows.stop:  # a pair once, and nothing with itself
                skip = np.arange(columns.start, columns.stop)[None, :] <= np.arange(rows.start, rows.stop)[:, None]
            i, j = near_pairs(members, rows, members, columns, threshold, skip)
            links.add(i + rows.start, j + columns.start)
    return links


def _placed(vertices: DataFrame, mean: np.ndarray, axes: np.ndarray, splits: int) -> DataFrame:
    """``key``, ``label``, ``dims``, ``n``, ``vector`` with ``cell`` (sides of the leading axes) and leading coordinates."""
    dims = axes.shape[0]
    boxed = min(LEADING, dims)
    given = broadcast_value(vertices, (mean, axes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        mean, axes = given.value
        centre = mean @ axes
        for batch in batches:
            if not batch.num_rows:
                continue
            turned = unit(matrix(batch.column(4), dims)) @ axes
            sides = turned[:, :splits] > centre[:splits]
            cell = (sides * (1 << np.arange(splits, dtype=np.int64))).sum(axis=1).astype(np.int64)
            yield {**{name: batch.column(k) for k, name in enumerate(("key", "label", "dims", "n", "vector"))},
                   "cell": cell, **{f"x{k}": turned[:, k] for k in range(boxed)}}

    source = vertices.select("key", "label", "dims", "n", "vector")
    label = source.schema["label"].dataType.simpleString()
    return map_batches(source, run, f"key long, label {label}, dims int, n long, vector array<double>, cell long, "
                       + ", ".join(f"x{k} double" for k in range(boxed)))


def _meetings(parts: DataFrame, boxed: int, threshold: float) -> DataFrame:
    """``a``, ``b``: parts of one label and length (a up to b) whose boxes are near enough for a link."""
    reach = 2 - 2 * threshold + SLACK  # squared distance of unit vectors at the threshold
    low = parts.select("label", "dims", F.col("part").alias("a"), *[F.col(f"{e}{k}").alias(f"a{e}{k}") for k in range(boxed) for e in ("low", "high")])
    high = parts.withColumnRenamed("part", "b")
    gaps = [F.greatest(F.col(f"low{k}") - F.col(f"ahigh{k}"), F.col(f"alow{k}") - F.col(f"high{k}"), F.lit(0.0)) for k in range(boxed)]
    return low.join(high, ["label", "dims"]).where((F.col("a") <= F.col("b")) & (sum(g * g for g in gaps) <= reach)).select("a", "b")


def cell_links(vertices: DataFrame, dims: int, threshold: float, part_rows: int) -> DataFrame:
    """``key``, ``links``, ``root``: for every cell and linked vertex, its partners' rows there and a linked vertex.

    ``root`` is one vertex of all that are linked with ``key`` inside the cell, so n linked vertices give n rows, never
    their pairs. Links with equal vectors are not counted; every two different vectors meet in one cell at most.
    """
    count = vertices.count()
    mean, axes = principal_axes(vertices, count, dims)
    boxed = min(LEADING, dims)
    # cells follow the largest label: where that fits one part, its rows are sent once
    largest = vertices.groupBy("label", "dims").count().agg(F.max("count")).first()[0]
    splits = min(MOST_AXES, dims, int((largest - 1) // part_rows).bit_length())
    placed = settle(_placed(vertices, mean, axes, splits), "placed")
    sizes = placed.groupBy("label", "dims", "cell").agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("lots"))
    dealt = placed.join(sizes, ["label", "dims", "cell"]).withColumn("lot", F.pmod(F.xxhash64("key"), F.col("lots")).cast("int"))
    boxes = dealt.groupBy("label", "dims", "cell", "lot").agg(
        *[f(f"x{k}").alias(f"{e}{k}") for k in range(boxed) for e, f in (("low", F.min), ("high", F.max))])
    parts = settle(boxes.withColumn("part", F.monotonically_increasing_id()), "parts")
    meet = settle(_meetings(parts, boxed, threshold), "meetings")
    sent = meet.select(F.col("a").alias("part"), "a", "b", F.lit(0).alias("side")).union(
        meet.where("a != b").select(F.col("b").alias("part"), "a", "b", F.lit(1).alias("side")))
    lots = parts.select("label", "dims", "cell", "lot", "part").join(sent, "part").drop("part")
    rows = dealt.select("label", "dims", "cell", "lot", "key", "n", "vector").join(lots, ["label", "dims", "cell", "lot"])
    given = broadcast_value(vertices, axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        axes = given.value
        for cell in whole_groups(batches, 2):
            if cell.num_rows < 2:
                continue
            key, weights = (cell.column(k).to_numpy().astype(np.int64) for k in (3, 4))
            members = Turned(matrix(cell.column(5), dims), axes)
            links = compare(members, cell.column(2).to_numpy(), weights, threshold)
            hit = np.flatnonzero(links.found)
            if len(hit):
                yield {"key": key[hit], "links": links.found[hit], "root": key[links.root[hit]]}

    source = rows.select("a", "b", "side", "key", "n", "vector").repartition("a", "b").sortWithinPartitions("a", "b", "side")
    return map_batches(source, run, "key long, links long, root long")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The rows of each group of the first ``keys`` columns (longs), which the batches are sorted by, as one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        starts = np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])
        for start, stop in zip(starts, [*starts[1:], batch.num_rows]):
            group = tuple(int(c[start]) for c in columns)
            if held and group != last:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            last = group
    if held:
        yield pa.concat_batches(held)


def near_duplicates(df: DataFrame, id_column: str = "vec_id", label_column: str = "label",
                    vector_column: str = "embedding", threshold: float = 0.98, part_rows: int = 16384) -> DataFrame:
    """``id``, ``n_links``, ``component`` and ``kept`` of every row.

    Rows are linked when their labels are equal and not null and their vectors' cosine, in double precision, is
    ``threshold`` or more (above 0). ``n_links`` counts the linked rows, ``component`` is the smallest id reachable.
    Equal vectors of a label are one vertex with a count, so copies are never compared with each other. A part has
    about ``part_rows`` vertices at most, so a task holds two parts, and a label, a cell or a group of copies of any size
    is spread over tasks.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor do vectors of
    different lengths. Rows may repeat; a repeated id names several rows. Null ids are linked like others, count as
    largest, and a component of null ids alone is null; such a row is kept. Other columns are not read.
    An empty table gives an empty one.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    rows = df.select(
        named(id_column).alias("id"), named(label_column).alias("label"), named(vector_column).cast("array<double>").alias("vector"))
    takes_part = F.col("label").isNotNull() & usable(F.col("vector")) & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    asked = rows.where(takes_part).withColumn("vector", F.transform("vector", lambda x: x + 0.0))  # -0.0 is 0.0
    others = rows.where(~F.coalesce(takes_part, F.lit(False)))
    vertices = settle(
        asked.groupBy("label", "vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
        .withColumn("dims", F.size("vector")).withColumn("key", F.monotonically_increasing_id()), "vectors")
    dims = vertices.agg(F.max("dims")).first()[0]
    alone = others.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"), F.lit(True).alias("kept"))
    if dims is None:
        return alone
    found = settle(cell_links(vertices, dims, threshold, part_rows), "cell-links")
    roots = components(found.select(F.col("key").alias("src"), F.col("root").alias("dst")))
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    rooted = vertices.select("key", "least").join(roots, F.col("key") == F.col("vertex"), "left").select(
        "key", "least", F.coalesce("root", "key").alias("root"))
    named_roots = rooted.groupBy("root").agg(F.min("least").alias("component"))
    told = settle(
        rooted.join(named_roots, "root").join(linked, "key", "left")
        .select("key", "component", F.coalesce("links", F.lit(0)).alias("links")), "components")
    verdict = vertices.select("key", "label", "vector", "n").join(told, "key").select(
        "label", "vector", "component", (F.col("links") + F.col("n") - 1).alias("n_links"))
    return asked.join(verdict, ["label", "vector"]).select(
        "id", "n_links", "component", F.col("id").eqNullSafe(F.col("component")).alias("kept")).unionByName(alone)
