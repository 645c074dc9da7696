"""Batched k-means against separate fits and numpy; Euclidean silhouette against all pairs."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from churnlens.operators import segment, silhouette
from churnlens.operators.blocks import BLOCK_ROWS, Block, loaded, reduced, stored_blocks, summed, uniform
from churnlens.operators.kmeans import SegmentFit, fit_many, moments, squared_distances, start_centers
from churnlens.operators.silhouette import References, add_distances, euclidean_silhouette, silhouette_of_fits, silhouettes

SF = "/root/testdata/sf0.001"


def points(n=300, d=5, k=4, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(scale=4, size=(k, d))
    return centers[rng.integers(k, size=n)] + rng.normal(size=(n, d))


def frame(spark, pts, parts=3):
    rows = [(i, [float(v) for v in p], i % 3) for i, p in enumerate(pts)]
    return spark.createDataFrame(rows, "id long, x array<double>, c int").repartition(parts)


def blocks_of(spark, pts):
    return loaded(stored_blocks(frame(spark, pts), F.col("x"), "test"))


def all_pairs(pts, own):
    d = np.sqrt(np.maximum(((pts[:, None] - pts[None]) ** 2).sum(-1), 0))
    out = []
    for i in range(len(pts)):
        mine = own == own[i]
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mine].sum() / (mine.sum() - 1)
        b = min(d[i, own == c].mean() for c in set(own) if c != own[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_blocks_keep_every_row_and_id(spark):
    df = spark.range(3 * BLOCK_ROWS + 7).select(F.array(F.col("id").cast("double"), F.col("id") * 2.0).alias("x"))
    b = loaded(stored_blocks(df.repartition(2), F.col("x"), "test"))
    n, total = 3 * BLOCK_ROWS + 7, summed(b, lambda b: np.array([len(b.x), len(np.unique(b.ids)), b.x[:, 0].sum()]))
    assert total.tolist() == [n, n, n * (n - 1) / 2] and b.map(lambda b: len(b.x)).max() <= BLOCK_ROWS
    ids = np.concatenate(b.map(lambda b: b.ids).collect())
    assert len(set(ids.tolist())) == n
    u = uniform(ids, 1, 2)
    assert 0 < u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01
    empty = loaded(stored_blocks(df.limit(0), F.col("x"), "test"))
    assert summed(empty, lambda b: b.x.sum(axis=0)) is None
    with pytest.raises(Exception, match="no number"):
        stored_blocks(spark.sql("select array(1d, null) as x"), F.col("x"), "test")


def test_one_total_of_many_tasks_reaches_the_driver(spark, monkeypatch):
    """Totals meet in tasks by tree, in the blocks' order, and ``finish`` runs there."""
    got, collect = [], RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda rdd: got.append(collect(rdd)) or got[-1])
    for parts in (1, 3, 40, 300):
        numbers = spark.sparkContext.parallelize(range(1000), parts)
        assert summed(numbers, lambda i: np.array([i, 1])).tolist() == [499500, 1000]
        assert summed(numbers, lambda i: np.array([i, 1]), lambda s: s[0] / s[1]) == 499.5
        assert reduced(numbers, lambda i: [i], lambda a, b: a + b, lambda a: a == sorted(a)) is True
    assert summed(spark.sparkContext.parallelize([5], 4), lambda i: i) == 5
    assert summed(spark.sparkContext.parallelize([], 20), lambda i: i) is None
    assert len(got) == 14 and max(map(len, got)) == 1


def test_memory_of_a_block(monkeypatch):
    """Scoring a block holds few of its distances at once; steps hold one matrix of them."""
    rng, k = np.random.default_rng(1), 8
    x, r = rng.normal(size=(BLOCK_ROWS, 16)), rng.normal(size=(k * 200, 16))
    own, refs = rng.integers(k, size=BLOCK_ROWS), References(r, np.arange(-len(r), 0) + 40, np.repeat(np.arange(k), 200), np.full(k, 5000))

    def peak(work):
        tracemalloc.start()
        out = work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most / 2**20

    found, most = peak(lambda: silhouettes(x, np.arange(BLOCK_ROWS), own, refs))
    assert most < 40
    monkeypatch.setattr(silhouette, "ROWS_AT_ONCE", BLOCK_ROWS)
    assert np.allclose(found, silhouettes(x, np.arange(BLOCK_ROWS), own, refs), atol=1e-12)
    assert silhouettes(x[:0], np.arange(0), own[:0], refs).shape == found[:0].shape
    far, most = peak(lambda: squared_distances(x, r))
    assert most < 1.2 * far.nbytes / 2**20


def test_together_equals_alone_and_numpy(spark):
    b = blocks_of(spark, points())
    wanted = [(k, 42 + s) for k in (2, 3, 4, 6) for s in range(3)]
    together = fit_many(b, wanted)
    x = np.concatenate(b.map(lambda b: b.x).collect())
    _, mean, variance = moments(b)
    assert np.allclose(mean, x.mean(0)) and np.allclose(variance, x.var(0))
    for f, one in zip(together, wanted):
        alone = fit_many(b, [one])[0]
        assert math.isclose(alone.inertia, f.inertia, rel_tol=1e-9) and np.allclose(alone.centers, f.centers)
        centers = start_centers(b, [one], mean)[0] + mean
        for _ in range(300):  # plain Lloyd steps from the same start
            own = squared_distances(x, centers).argmin(1)
            new = np.array([x[own == c].mean(0) if (own == c).any() else centers[c] for c in range(f.k)])
            shift, centers = ((new - centers) ** 2).sum(), new
            if shift <= 1e-4 * variance.mean():
                break
        assert math.isclose(squared_distances(x, centers).min(1).sum(), f.inertia, rel_tol=1e-9)


def test_fewer_distinct_rows_than_centres(spark):
    fit = fit_many(blocks_of(spark, np.repeat([[0.0, 1.0], [5.0, 5.0]], 10, axis=0)), [(4, 1)])[0]
    assert fit.inertia == pytest.approx(0, abs=1e-18)


def test_assignment_in_spark_is_the_nearest_centre(spark):
    pts = points()
    df = frame(spark, pts)
    fit = segment.fit_segments(df.select(array_to_vector("x").alias("features")), 4, n_init=2)
    got = fit.assign(df.withColumn("features", array_to_vector("x"))).orderBy("id").toPandas()["cluster"]
    assert got.tolist() == squared_distances(pts, fit.centers).argmin(1).tolist()
    wide = df.select("id", *[F.col("x")[i].alias(f"f{i}") for i in range(5)])
    named = wide.selectExpr("id", f"{fit.sql([f'f{i}' for i in range(5)])} AS cluster").orderBy("id").toPandas()["cluster"]
    assert named.tolist() == got.tolist()


def test_silhouette_is_exact_with_all_rows_and_near_with_few(spark):
    pts = points(n=900, k=5)
    b = blocks_of(spark, pts)
    fits = fit_many(b, [(3, 1), (5, 2)])
    exact = [all_pairs(pts, squared_distances(pts, f.centers).argmin(1)) for f in fits]
    for (got, error), want in zip(silhouette_of_fits(b, fits, per_cluster=1000), exact):
        assert got == pytest.approx(want, abs=1e-9) and error == 0.0
    for seed in range(3):
        for (got, error), want in zip(silhouette_of_fits(b, fits, per_cluster=60, seed=seed), exact):
            assert 0 < error < 0.05 and abs(got - want) <= 4 * error


def test_silhouette_of_given_clusters(spark):
    pts = np.concatenate([points(n=150), [[50.0] * 5]])
    own = np.array([i % 3 for i in range(150)] + [7])
    df = spark.createDataFrame([(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(pts, own))],
                               "id long, x array<double>, c int")
    df = df.union(spark.createDataFrame([(999, [0.0] * 5, None)], "id long, x array<double>, c int"))
    row = euclidean_silhouette(df, "id", "c", "x", 1000).first()
    assert (row.n, row.n_references, row.standard_error) == (151, 151, 0.0)
    assert row.silhouette == pytest.approx(all_pairs(pts, own), abs=1e-9)
    few = euclidean_silhouette(df, "id", "c", "x", 20).first()
    assert few.n_references == 61 and abs(few.silhouette - row.silhouette) <= 5 * few.standard_error
    assert euclidean_silhouette(df.where("id < 0"), "id", "c", "x").first().n == 0


def test_sweep_scores_every_row_against_every_row(spark, monkeypatch):
    """Clusters of far more rows than any reference set: silhouettes are those of all pairs, whichever blocks rows are in."""
    pts = points(n=1900, d=3, k=3, seed=8) * 0.5
    df = frame(spark, pts).select(array_to_vector("x").alias("features"))
    table, _ = segment.sweep_k(df, (2, 3, 5), n_init=2)
    rows = {r["k"]: r for r in table.collect()}
    b = blocks_of(spark, pts)
    for k, row in rows.items():
        fit = segment.fit_segments(df, k, n_init=2)
        assert row["silhouette"] == pytest.approx(all_pairs(pts, squared_distances(pts, fit.centers).argmin(1)), abs=1e-9)
        assert row["standard_error"] == 0.0
        for parts in (1, 2):  # several blocks a task
            assert silhouette_of_fits(b.coalesce(parts), [fit])[0][0] == pytest.approx(row["silhouette"], abs=1e-12)
    many = b.flatMap(lambda b: [Block(b.x[i:i + 9], b.ids[i:i + 9]) for i in range(0, len(b.x), 9)]).repartition(40)
    blocks_met = []
    monkeypatch.setattr(RDD, "cartesian", lambda a, b, whole=RDD.cartesian: blocks_met.append(a.count()) or whole(a, b))
    assert silhouette_of_fits(many, [fit])[0][0] == pytest.approx(row["silhouette"], abs=1e-12)
    assert blocks_met[0] <= max(1, many.context.defaultParallelism) < many.count()  # small blocks are put together first


def test_silhouette_of_lone_repeated_and_no_rows(spark):
    pts = np.concatenate([points(n=700, d=2, k=2), np.repeat([[40.0, 40.0]], 5, axis=0), [[90.0, -90.0]]])
    fits = [SegmentFit(k, 0, np.array([[0.0, 0.0], [40.0, 40.0], [90.0, -90.0], [1e3, 1e3]])[:k], 0.0, 1) for k in (1, 3, 4)]
    one, three, four = [s for s, _ in silhouette_of_fits(blocks_of(spark, pts), fits)]
    want = all_pairs(pts, squared_distances(pts, fits[1].centers).argmin(1))
    assert one == 0.0 and three == pytest.approx(want, abs=1e-9) and four == three


def test_memory_of_a_pair_of_blocks():
    """Two blocks that meet hold few of their distances at once."""
    rng = np.random.default_rng(1)
    x, y, own = rng.normal(size=(BLOCK_ROWS, 16)), rng.normal(size=(700, 16)), rng.integers(4, size=(1, BLOCK_ROWS))
    out = np.zeros((4, len(y)))
    tracemalloc.start()
    add_distances(out, y, x, own, [0], False)
    most = tracemalloc.get_traced_memory()[1] / 2**20
    tracemalloc.stop()
    far = np.sqrt(squared_distances(y, x))
    assert most < 12 and np.allclose(out.T, np.stack([far[:, own[0] == c].sum(axis=1) for c in range(4)], axis=1))
