"""Embedding operators against brute force: near duplicates, whitening, hard negatives."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import embedding_dedup, hard_negatives, vectors, whitening
from linkloom.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def fine(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    for name in ("key", "n", "cell", "part", "x0", "links", "component", "block"):  # names the operators use themselves
        df = df.withColumn(name, F.lit("x"))
    return df


def clustered(seed, rows, dims=12, copies=40, near=60):
    """Random rows of few labels, a large group of copies, a large near group, a chain, a scaled copy and odd rows."""
    draw = np.random.default_rng(seed)
    found = [(k, int(draw.integers(0, 3)), draw.normal(size=dims).tolist()) for k in range(rows)]
    centre = draw.normal(size=dims)
    found += [(1000 + k, 1, centre.tolist()) for k in range(copies)]
    found += [(2000 + k, 2, (centre + draw.normal(size=dims) * 0.08).tolist()) for k in range(near)]
    a, b = np.eye(dims)[0], np.eye(dims)[1]
    found += [(3000 + k, 0, (math.cos(k * 0.15) * a + math.sin(k * 0.15) * b).tolist()) for k in range(10)]
    found += [(4000, 1, (centre * 3).tolist()), (4001, None, centre.tolist()), (4002, 1, None), (4003, 1, [0.0] * dims),
              (4004, 1, [None, *centre[1:].tolist()]), (4005, 1, [NAN] * dims), (4006, 1, [INF] * dims), (4007, 1, []),
              (4008, 1, centre[:5].tolist()), (4008, 1, centre[:5].tolist()), (4009, 1, [-0.0] * dims), (1000, 1, centre.tolist())]
    random.Random(seed).shuffle(found)
    return found


def plain_links(rows, threshold=0.98):
    kept = [(i, label, np.array(v, np.float32).astype(float)) for i, (_, label, v) in enumerate(rows) if label is not None and fine(v) and any(v)]
    degree, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, label, v) in enumerate(kept):
        for j, other, w in kept[:n]:
            if label == other and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= threshold:
                degree[i] += 1
                degree[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i, row in enumerate(rows):
        least[root(i)] = min(least.get(root(i), row[0]), row[0])
    return sorted((row[0], degree[i], least[root(i)], row[0] == least[root(i)]) for i, row in enumerate(rows))


@pytest.mark.parametrize("part_rows", [16, 16384])
def test_near_duplicates_against_brute_force(spark, part_rows):
    rows = clustered(1, 150)
    found = embedding_dedup.near_duplicates(table(spark, rows), part_rows=part_rows).collect()
    assert sorted(tuple(r) for r in found) == plain_links(rows)


def test_every_step_of_a_comparison():
    draw = np.random.default_rng(3)
    base = draw.normal(size=(40, 64)) * np.linspace(2, 0.1, 64)
    near = np.repeat(base, 5, axis=0) + draw.normal(size=(200, 64)) * 0.02
    for rows in (near, near[:5], draw.normal(size=(700, 64))):
        _, axes = np.linalg.eigh(np.cov(rows.T))
        turned = embedding_dedup.Turned(rows, np.ascontiguousarray(axes[:, ::-1]))
        links = embedding_dedup.compare(turned, np.zeros(len(rows), int), np.ones(len(rows), int), 0.98)
        plain = turned.units @ turned.units.T >= 0.98
        assert (links.found == plain.sum(axis=1) - 1).all()
        half = np.r_[np.zeros(len(rows) // 2, int), np.ones(len(rows) - len(rows) // 2, int)]
        across = embedding_dedup.compare(turned, half, np.ones(len(rows), int), 0.98)
        assert (across.found == (plain & (half[:, None] != half[None, :])).sum(axis=1)).all()


def test_tiles_out_of_reach_are_abandoned(monkeypatch):
    draw = np.random.default_rng(4)
    rows = np.vstack([draw.normal(size=(50, 32)) * 0.01 + np.eye(32)[k] for k in (0, 1)])
    _, axes = np.linalg.eigh(np.cov(rows.T))
    turned = embedding_dedup.Turned(rows, np.ascontiguousarray(axes[:, ::-1]))
    monkeypatch.setattr(np, "einsum", lambda *a: pytest.fail("went past the leading dimensions"))
    assert not len(embedding_dedup.near_pairs(turned, slice(0, 50), turned, slice(50, 100), 0.98)[0])


def test_far_parts_never_meet(spark):
    draw = np.random.default_rng(5)
    rows = [(k, 0, (np.eye(8)[k % 4] * 5 + draw.normal(size=8) * 0.05).tolist()) for k in range(256)]
    df = table(spark, rows).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vector"))
    vertices = df.select(F.col("vec_id").alias("key"), "label", F.lit(8).alias("dims"), F.lit(1).cast("long").alias("n"), "vector")
    _, axes = embedding_dedup.principal_axes(vertices, 256, 8)
    assert np.allclose(axes.T @ axes, np.eye(8))
    placed = embedding_dedup._placed(vertices, _, axes, 3)
    boxes = placed.groupBy("label", "dims", "cell").agg(
        *[f(f"x{k}").alias(f"{e}{k}") for k in range(8) for e, f in (("low", F.min), ("high", F.max))])
    meet = embedding_dedup._meetings(boxes.withColumnRenamed("cell", "part"), 8, 0.98).collect()
    assert len(meet) < boxes.count() ** 2 / 2  # groups on different axes are out of reach


def test_near_duplicates_odd_tables(spark):
    rows = clustered(2, 5)
    assert embedding_dedup.near_duplicates(table(spark, rows).limit(0)).count() == 0
    alone = embedding_dedup.near_duplicates(table(spark, [(1, None, [1.0]), (2, 1, None), (None, 1, [])])).collect()
    assert sorted(((r.id, r.n_links, r.component, r.kept) for r in alone), key=str) == [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)]
    ids = embedding_dedup.near_duplicates(table(spark, [(None, 1, [1.0, 2.0]), (None, 1, [1.0, 2.0]), (None, 1, [2.0, -1.0]), (9, 1, [2.0, -1.0])])).collect()
    assert sorted(((r.id, r.n_links, r.component, r.kept) for r in ids), key=str) == [
        (9, 1, 9, True), (None, 1, 9, False), (None, 1, None, True), (None, 1, None, True)]


def test_near_duplicates_of_given_tables(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    assert sorted(tuple(r) for r in QUERIES["op11_embedding_dedup"](spark, sf).collect()) == plain_links(rows)


def plain_whitening(vecs, weights=None):
    x = np.array(vecs, dtype=object)
    n = int(sum(weights)) if weights else len(x)
    w = np.array(weights or [1] * len(x), dtype=object)
    sums = (x * w[:, None]).sum(axis=0)
    deviation = [int(((n * v - sums) ** 2).sum()) for v in x]
    centred = (x * n - sums).astype(float) / n
    v = (centred * w[:, None].astype(float)).T @ centred / n
    e, axes = np.linalg.eigh(v)
    return n, deviation, centred, v, e[::-1], axes[:, ::-1]


@pytest.mark.parametrize("weight", ["one", "count"])
def test_whitening_against_brute_force(spark, weight):
    draw = np.random.default_rng(7)
    rows = [(k, 1, (draw.normal(size=6) * np.arange(6, 0, -1) * 0.1).astype(np.float32).tolist()) for k in range(200)]
    rows += [(500 + k, 2, rows[0][2]) for k in range(90)] + [(700, 1, [v + 1e-5 for v in rows[1][2]])]
    rows += [(800, 1, None), (801, 1, [None] * 6), (802, 1, [NAN] * 6), (803, 1, [INF] * 6), (804, 1, []), (805, 1, [1.0]), (None, None, rows[3][2])]
    found = whitening.whiten(table(spark, rows), components=4, weight=weight).collect()
    kept = [r for r in rows if fine(r[2]) and len(r[2]) == 6]
    whole = {}
    for _, _, v in kept:
        key = tuple(math.floor(64 * float(np.float32(x))) + 1000000 for x in v)
        whole[key] = whole.get(key, 0) + 1
    n, deviation, centred, v, e, axes = plain_whitening(list(whole), list(whole.values()) if weight == "count" else None)
    assert sorted(str(r.id) for r in found) == sorted(str(r[0]) for r in kept)
    place = {key: k for k, key in enumerate(whole)}
    plain = centred @ axes[:, :4] / np.sqrt(e[:4])
    sign = None
    by_id = {r.id: r for r in found}
    for i, _, vec in kept:
        k = place[tuple(math.floor(64 * float(np.float32(x))) + 1000000 for x in vec)]
        r = by_id[i]
        assert r.n == n and int(r.deviation) == deviation[k] and r.identity_error < 1e-9
        assert np.allclose(r.explained, e[:4] / np.trace(v), rtol=1e-9)
        if sign is None:
            sign = np.sign(np.array(r.whitened) * plain[k])
        assert np.allclose(np.array(r.whitened) * sign, plain[k], atol=1e-7)


def test_exact_deviations():
    x = np.array([[2 ** 31 - 5, -(2 ** 31) + 9], [3, 4]])
    n, sums = 2 ** 29, np.array([2 ** 50, -(2 ** 49)])
    plain = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    assert whitening.exact_deviations(x, n, sums) == plain
    assert whitening.exact_deviations(x[1:], 5, np.array([1, 2])) == [(15 - 1) ** 2 + (20 - 2) ** 2]


def test_whitening_odd_tables(spark):
    rows = [(1, 1, [0.5, 0.25]), (2, 1, [0.5, 0.25])]
    assert whitening.whiten(table(spark, rows).limit(0)).count() == 0
    same = whitening.whiten(table(spark, rows)).collect()
    assert [(r.id, r.n, int(r.deviation), r.whitened) for r in same] == [(1, 1, 0, []), (2, 1, 0, [])]
    flat = whitening.whiten(table(spark, [(k, 1, [0.1 * k, 0.1 * k]) for k in range(5)])).collect()
    assert all(len(r.whitened) == 1 and abs(r.identity_error) < 1e-9 for r in flat)


def test_whitening_query(spark, sf):
    rows = QUERIES["op12_whitening"](spark, sf).collect()
    data = [tuple(math.floor(64 * x) + 1000000 for x in r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    n, _, _, v, e, _ = plain_whitening(sorted(set(data)))
    assert len(rows) == 16 * len(data) and {r.n for r in rows} == {n}
    for r in rows[:64]:
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-9 and r.identity_error < 1e-9


def test_sums_of_wide_matrices(spark):
    draw = np.random.default_rng(8)
    data = draw.integers(-5, 5, (300, 150))
    df = spark.createDataFrame([(row.tolist(),) for row in data], "v array<long>").repartition(5)
    total = vectors.add_up(df, (150, 150), lambda b: (m := vectors.matrix(b.column(0), 150, np.int64)).T @ m, "long")
    assert (total == data.T @ data).all()
    assert (vectors.add_up(df.limit(0), (2, 70), lambda b: 1 / 0) == 0).all()


def plain_negatives(rows, every):
    kept = [(k, i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for k, (i, label, v) in enumerate(rows)
            if i is not None and label is not None and fine(v)]
    out = []
    for k, i, label, c in kept:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(c, d)), j, m, other) for m, j, other, d in kept if m != k]
        for s, j, _, _ in sorted(x[:2] + (0, 0) for x in scored if x[3] == label)[:5]:
            fit = sorted((t, g) for t, g, _, other in scored if other != label and 50 * -s <= 100 * -t <= 95 * -s)[:3]
            out += [(i, j, rank, g, -s, -t) for rank, (t, g) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 4, "part_rows": 16}])
def test_hard_negatives_against_brute_force(spark, sizes):
    rows = clustered(9, 120) + [(50, 1, [0.5] * 12), (50, 1, [0.5] * 12), (None, 1, [0.5] * 12), (51, 2, [0.4] * 12), (51, 2, [0.4] * 12)]
    found = hard_negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0, **sizes).collect()
    assert sorted(tuple(r) for r in found) == plain_negatives(rows, 10)


def test_packed_products_are_exact():
    draw = np.random.default_rng(10)
    for low, high in ((-256, 256), (-(2 ** 24), 2 ** 24), (0, 1), (-1, 0), (5, 9)):
        c = draw.integers(low, high, (37, 64))
        a = draw.integers(low, high, 64)
        bias = -int(min(a.min(), 0))
        packed = hard_negatives.Packed(c, int((a + bias).max()))
        assert (packed.scores((a + bias).tolist(), bias) == c @ a).all()
    extreme = np.full((3, 64), -256)
    assert (hard_negatives.Packed(extreme, 0).scores([0] * 64, 256) == extreme @ np.full(64, -256)).all()


def test_text_labels_and_empty_tables(spark):
    rows = clustered(11, 60)
    plain = hard_negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0).collect()
    worded = hard_negatives.mine(table(spark, rows).withColumn("label", F.concat(F.lit("l"), "label")), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, worded))
    assert hard_negatives.mine(table(spark, rows).limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(table(spark, rows), F.lit(None).cast("boolean")).count() == 0
