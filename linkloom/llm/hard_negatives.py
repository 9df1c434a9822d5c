"""Hard negatives by Kronecker-packed inner products.

Components are whole numbers. For a block of candidates, the biased components of one dimension stand side by side
in the fields of one wide integer. An anchor's component multiplies all of them at once; the sum of these products
over the dimensions holds one biased inner product a field, none of which can run into the next, because the field's
width is chosen from the largest components. Taking the biases out gives exact scores.

Anchors are dealt out in blocks and candidates in parts; each block meets each part in a cell of its own. A cell keeps
the few best rows of each anchor, and these are merged. No pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import map_batches, named
from linkloom.llm.embedding_dedup import whole_groups
from linkloom.llm.vectors import matrix, usable
from linkloom.session import settle

LARGEST = 2.0 ** 16  # vectors with a component from here on take no part: below, scores fit a long
STEP = 8192  # candidates of one wide integer


class Packed:
    """Candidates' components (rows, dims) as one wide integer a dimension."""

    def __init__(self, components: np.ndarray, largest_anchor: int):
        """``largest_anchor`` is the largest biased component that an anchor may have."""
        self.rows, dims = components.shape
        self.bias = -int(components.min(initial=0))
        biased = components + self.bias
        most = dims * int(biased.max(initial=0)) * largest_anchor
        self.width = next((w for w in (4, 8) if most < 1 << 8 * w), 0)
        if not self.width:
            raise ValueError("the components are too large for exact scores")
        self.kind = f"<u{self.width}"
        self.sums = components.sum(axis=1)
        self.words = [int.from_bytes(column.tobytes(), "little") for column in biased.T.astype(self.kind)]

    def scores(self, anchor: list[int], anchor_bias: int) -> np.ndarray:
        """Inner products with every candidate of an anchor given as its components plus ``anchor_bias``, none negative."""
        total = 0
        for component, word in zip(anchor, self.words):
            total += component * word
        fields = np.frombuffer(total.to_bytes(self.rows * self.width, "little"), self.kind).astype(np.int64)
        # (a + A)(b + B) = ab + Ab + (a + A)B, summed over the dimensions
        return fields - anchor_bias * self.sums - self.bias * sum(anchor)


def best(scores: np.ndarray, among: np.ndarray, count: int) -> np.ndarray:
    """Which of ``among`` (rising numbers) have the ``count`` highest scores, the lower number first among equals."""
    if len(among) > count:
        own = scores[among]
        among = among[own >= np.partition(own, len(own) - count)[len(own) - count]]
    return among[np.argsort(-scores[among], kind="stable")][:count]


def whole_components(df: DataFrame, anchors: Column, id_column: str, label: Column, vector_column: str, scale: int) -> DataFrame:
    """``key``, ``id``, ``label`` (a long code), ``anchor`` and ``c`` (array of int) of the rows that take part."""
    rows = df.select(named(id_column).cast("long").alias("id"), label.alias("label"),
                     F.coalesce(anchors, F.lit(False)).alias("anchor"), named(vector_column).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v"), LARGEST))
    rows = rows.select("id", "label", "anchor", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("c"))
    if rows.schema["label"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        rows = rows.withColumn("label", F.col("label").cast("long"))
    else:
        codes = settle(rows.select("label").distinct().withColumn("code", F.monotonically_increasing_id()), "label-codes")
        rows = rows.join(codes, "label").drop("label").withColumnRenamed("code", "label")
    return settle(rows.withColumn("key", F.monotonically_increasing_id()), "components")


def _lots(count: Column, rows: int) -> Column:
    return F.ceil(count / F.lit(rows)).cast("int")


def _cells(anchors: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each block of anchors beside each part of candidates of the same ``group``, in one partition and sorted.

    Both have ``group``, ``blocks`` and ``parts``: into how many lots the anchors and the candidates of their group go.
    """
    def dealt(df: DataFrame, side: int, own: str, other: str) -> DataFrame:
        lot = F.pmod(F.xxhash64("key"), F.col(f"{own}s")).cast("int")
        spread = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))
        return df.withColumn(own, lot).withColumn(other, spread).select(
            "group", "block", "part", F.lit(side).alias("side"), "id", "key", "label", "c", "positives")

    order = ["group", "block", "part"]
    both = dealt(anchors, 0, "block", "part").union(dealt(candidates, 1, "part", "block"))
    return both.repartition(*order).sortWithinPartitions(*order, "side", "id")


POSITIVES = "array<struct<nth:int,id:bigint,score:bigint>>"


def _best_of_cells(cells: DataFrame, dims: int, positives: int, negatives: int, percent: tuple[int, int] | None) -> DataFrame:
    """``anchor_key``, ``anchor_id``, ``nth``, ``positive_id``, ``positive_score``, ``id``, ``score``: each cell's best rows.

    Without ``percent``: the best other rows (``nth`` and the positive are null). With it: for each positive of the
    anchor, the best rows of another label whose score is between these percentages of the positive's.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for cell in whole_groups(batches, 3):
            second = int(np.searchsorted(cell.column(3).to_numpy(), 1))
            if second in (0, cell.num_rows):
                continue
            ids, keys, labels = (cell.column(k).to_numpy() for k in (4, 5, 6))
            c = matrix(cell.column(7), dims, np.int64)
            bias = -int(c[:second].min(initial=0))
            biased = (c[:second] + bias)
            asked = cell.column(8).slice(0, second).to_pylist() if percent else [None] * second
            for start in range(second, cell.num_rows, STEP):
                part = slice(start, start + STEP)
                packed = Packed(c[part], int(biased.max(initial=0)))
                rows = []
                for a in range(second):
                    scores = packed.scores(biased[a].tolist(), bias)
                    if percent is None:
                        chosen = best(scores, np.flatnonzero(keys[part] != keys[a]), positives)
                        rows += [(a, None, None, None, start + k, scores[k]) for k in chosen.tolist()]
                    else:
                        rows += _between(scores, labels[part] != labels[a], asked[a], percent, negatives, a, start)
                if rows:
                    a, nth, positive, positive_score, k, score = zip(*rows)
                    yield {"anchor_key": keys[list(a)], "anchor_id": ids[list(a)], "nth": nth, "positive_id": positive,
                           "positive_score": positive_score, "id": ids[list(k)], "score": score}

    schema = "anchor_key long, anchor_id long, nth int, positive_id long, positive_score long, id long, score long"
    return map_batches(cells, run, schema)


def _between(scores: np.ndarray, other: np.ndarray, positives: list[dict], percent: tuple[int, int], negatives: int,
             anchor: int, start: int) -> list[tuple]:
    low, high = percent
    ranges = [(-(-low * p["score"] // 100), high * p["score"] // 100, p) for p in positives]
    ranges = [r for r in ranges if r[0] <= r[1]]
    if not ranges:
        return []
    some = np.flatnonzero(other & (scores >= min(r[0] for r in ranges)) & (scores <= max(r[1] for r in ranges)))
    if not len(some):
        return []
    own = scores[some]
    found = []
    for least, most, p in ranges:
        chosen = best(scores, some[(own >= least) & (own <= most)], negatives)
        found += [(anchor, p["nth"], p["id"], p["score"], start + k, scores[k]) for k in chosen.tolist()]
    return found


def mine(df: DataFrame, anchors: Column, id_column: str = "vec_id", label: Column | None = None, vector_column: str = "embedding",
         positives: int = 5, negatives: int = 3, percent: tuple[int, int] = (50, 95), scale: int = 256,
         block_rows: int = 32768, part_rows: int = 8192) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A row's score is its whole-number inner product with the anchor, components being floor(scale x). An anchor's
    positives are its ``positives`` best other rows of the same label; for each of them the ``negatives`` best rows of
    another label whose score lies between the two percentages of the positive's are returned, best first. Ties
    go to the smaller id. All rows of ``anchors`` (a condition over the columns of ``df``) are scored against all rows.

    Rows with a null id or label, or a vector that is null, empty, or holds a null, a non-finite component or one of
    2^16 and more take no part; shorter vectors end in zeros. A repeated row is a row of its own: an anchor's copy can be its
    positive, and repeated anchors each have their results. Anchors without positives or negatives give no
    rows; an empty table gives none. Other columns are read only by ``anchors`` and ``label``.

    A cell holds about ``block_rows`` anchors and ``part_rows`` candidates, whatever the size of a label.
    """
    rows = whole_components(df, anchors, id_column, named("label") if label is None else label, vector_column, scale)
    total = rows.agg(F.max(F.size("c")).alias("dims"), F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).first()
    dims = total["dims"] or 1
    no_positives = F.lit(None).cast(POSITIVES).alias("positives")

    counted = rows.groupBy("label").agg(F.count_if("anchor").alias("a"), F.count(F.lit(1)).alias("n"))
    lots = counted.where("a > 0").select("label", _lots(F.col("a"), block_rows).alias("blocks"), _lots(F.col("n"), part_rows).alias("parts"))
    labelled = rows.join(lots, "label").withColumn("group", F.col("label")).withColumn("positives", no_positives)
    near = _best_of_cells(_cells(labelled.where("anchor"), labelled), dims, positives, negatives, None)
    order = Window.partitionBy("anchor_key").orderBy(F.desc("score"), "id")
    ranked = near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    # at most `positives` a list
    chosen = settle(ranked.groupBy(F.col("anchor_key").alias("key")).agg(
        F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).cast(POSITIVES).alias("positives")), "positives")

    whole = rows.withColumns({"group": F.lit(0).cast("long"), "blocks": _lots(F.lit(max(total["anchors"], 1)), block_rows),
                              "parts": _lots(F.lit(max(total["n"], 1)), part_rows)})
    cells = _cells(whole.where("anchor").join(chosen, "key"), whole.withColumn("positives", no_positives))
    found = _best_of_cells(cells, dims, positives, negatives, percent)
    order = Window.partitionBy("anchor_key", "nth").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
