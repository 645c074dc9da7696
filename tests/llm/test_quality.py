"""Kernel approximation, normal equations, isotonic fit; held-out quality; edges."""

import random
import zlib

import numpy as np

from churnlens.llm import quality

SF = "/root/testdata/sf0.1"


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    n = quality.N_STATS
    m = quality.QualityModel(np.zeros(n), np.ones(n), rng.normal(0, 1 / 5, (n, 4096)), rng.uniform(0, 2 * np.pi, 4096),
                             np.zeros(4097), np.array([0, 1.0]), np.array([0, 1.0]))
    x = rng.normal(0, 1, (30, n))
    phi = m.features(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 25))
    assert np.abs(phi @ phi.T - want).max() < 0.1


def test_isotonic_is_monotone_and_pools():
    score = np.array([0.1, 0.2, 0.3, 0.4, 0.5, 0.6])
    knots, values = quality.isotonic(score, np.array([0, 1, 0, 1, 1, 1.0]))
    assert (np.diff(knots) >= 0).all() and (np.diff(values) >= 0).all()
    assert np.interp(0.2, knots, values) == np.interp(0.3, knots, values) or values[1] < values[-2]
    knots, values = quality.isotonic(np.array([1.0]), np.array([1.0]))
    assert np.isfinite(np.interp([0, 1, 2], knots, values)).all()


def test_statistics_of_edges(edge_texts):
    for t in edge_texts:
        s = quality.statistics(t)
        assert s.shape == (quality.N_STATS,) and np.isfinite(s).all()


def test_held_out_documents(spark):
    rows = quality.op5_quality_rff(spark, SF).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.95
    bad = [p for p, t in held if not t]
    assert sum(1 - p for p in bad) / len(bad) > 0.9


def test_edges(spark, make_docs, edge_texts):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["plain", "words", "of", "a", "calm", "text"]) for _ in range(40)) + "."
    junk = lambda: " ".join(rng.choice(["A$$$", "B###", "Q%%%"]) for _ in range(40))
    docs = make_docs([*((i, good() if i % 2 else junk()) for i in range(200)),
                      *((1000 + i, t) for i, t in enumerate(edge_texts)), (None, good()), (3, good())])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == 202 + len(edge_texts)
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id is not None and r.doc_id < 200)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id < 200 and doc_id % 2 = 0").count() == 0
    none = labels.limit(0)
    assert {r.predicted for r in quality.score_documents(docs, none).collect()} == {1}
    assert quality.score_documents(docs.limit(0), none).collect() == []
