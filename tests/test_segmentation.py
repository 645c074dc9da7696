"""k-means sweep, PCA projection, canonical ids, report sink."""

import math

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from churnlens.operators import segment
from churnlens.sources.subscribers import write_report


def blobs(spark, n=240, seed=5):
    rng = np.random.default_rng(seed)
    centers = np.array([[0, 0, 0], [6, 0, 1], [0, 6, -1]], dtype=float)
    pts = np.vstack([c + rng.normal(scale=0.7, size=(n // 3, 3)) for c in centers])
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    return df.select("id", array_to_vector("x").alias("features")), pts


def test_sweep_picks_true_k_and_inertia_decreases(spark):
    df, _ = blobs(spark)
    table, best = segment.sweep_k(df, (2, 3, 4, 5), n_init=3, seed=1)
    rows = sorted(table.collect(), key=lambda r: r["k"])
    inertia = [r["inertia"] for r in rows]
    assert all(b <= a * 1.0001 for a, b in zip(inertia, inertia[1:]))
    assert best.k == 3 and [r["k"] for r in rows if r["best"]] == [3]


def test_pca_ratios_match_eigenvalues(spark):
    df, pts = blobs(spark)
    z = (pts - pts.mean(0)) / pts.std(0)
    zdf = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(z)], "id long, x array<double>") \
               .select("id", array_to_vector("x").alias("f"))
    out, ratios = segment.project_2d(zdf, "f", key="id")
    ev = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    assert np.allclose(ratios, ev[:2] / ev.sum(), atol=1e-9)
    assert sum(ratios) <= 1.0
    pc = out.orderBy("id").toPandas()[["pc1", "pc2"]].to_numpy()
    assert np.allclose(pc.var(0, ddof=1), ev[:2], rtol=1e-6)


def test_canonical_ids_order_by_risk(spark):
    df = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (1, 1), (2, 0)], "c int, y int")
    m = {r["c"]: r["segment_id"] for r in segment.canonical_ids(df, "c", "y").collect()}
    assert m == {1: 1, 0: 2, 2: 3}
    with_null = df.union(spark.createDataFrame([(None, 1)], "c int, y int"))
    assert {r["c"]: r["segment_id"] for r in segment.canonical_ids(with_null, "c", "y").collect()} == {**m, None: None}


def test_crosstab_keeps_every_level(spark):
    df = spark.range(2400).select((F.col("id") % 2).cast("int").alias("s"), F.concat(F.lit("l"), F.col("id") % 1200).alias("c"))
    rows = segment.crosstab(df.union(spark.createDataFrame([(0, None), (None, "l7")], "s int, c string")), "s", "c").collect()
    assert len(rows) == 1200 + 1
    assert sum(r["n"] for r in rows) == 2401 and {r["pct"] for r in rows} == {0.2, 100.0}


def test_fit_segments_finds_the_blobs(spark):
    df, pts = blobs(spark)
    fit = segment.fit_segments(df.cache(), 3, n_init=2, seed=1)
    centres = sorted(c.round(0).tolist()[:2] for c in fit.centers)
    assert centres == [[0.0, 0.0], [0.0, 6.0], [6.0, 0.0]]


def test_stored_segments_are_assigned_again(spark, scratch):
    from churnlens.plans import flows
    from churnlens.schema import SegmentConfig, SubscriberColumns

    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(0, 2)), float(10 * (i % 3) + rng.normal()), float(rng.normal()), float(i), 0, "ab"[i % 2], "Yes")
            for i in range(150)]
    cols = SubscriberColumns(key="k", label="y", tenure="t", monthly="m", total="tot", senior="sen", contract="c",
                             numeric=("t", "m"), cluster_flags=("f",), cluster_onehot=(("c", "c"),))
    df = spark.createDataFrame(rows, "k long, y int, t double, m double, tot double, sen int, c string, f string")
    cfg = SegmentConfig(k_values=(2, 3), n_init=2)
    s = flows.segmentation(df, cols, cfg)
    flows.save_segments(s, f"{scratch}/segments")
    again = flows.assign_stored_segments(df, f"{scratch}/segments")
    ids = lambda d: {r["k"]: r["segment_id"] for r in d.select("k", "segment_id").collect()}
    assert ids(again) == ids(s.segmented) and len(ids(again)) == 150
    assert s.points.count() == 150 and 0 < sum(r["share"] for r in s.shares.collect()) <= 1.0 + 1e-9
    assert flows.segmentation(df, cols, cfg, k=2).sweep.count() == 1


def test_write_report(spark, scratch):
    df = spark.range(3).withColumn("x", F.col("id") * 2)
    path = write_report(df, scratch, "fig_table")
    assert spark.read.parquet(path).count() == 3
    assert math.isclose(spark.read.parquet(path).agg(F.sum("x")).first()[0], 6)
