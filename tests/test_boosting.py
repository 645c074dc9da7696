"""Trees against a direct computation on a small table; folds, sampling, storage, contributions."""

import math
import pickle

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from churnlens.operators import boosting, metrics, models
from churnlens.operators.blocks import loaded, stored_blocks, uniform
from churnlens.operators.encode import fit_model_features
from churnlens.operators.treeshap import ensemble_shap
from churnlens.schema import FIXTURE, GBTConfig
from churnlens.sources.fixture_view import subscriber_view
from churnlens.sources.model_store import read_model, save_model

NAMES = ("a", "b", "c", "d")


def table(spark, n=240, seed=2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(1), rng.integers(0, 2, n), rng.exponential(size=n).round(1), rng.integers(0, 5, n)])
    y = (rng.random(n) < 1 / (1 + np.exp(-(x[:, 0] + 2 * x[:, 1] - x[:, 2])))).astype(int)
    rows = [(*map(float, r), int(t), i % 3) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y int, fold int").repartition(3)


def plain():
    return PipelineModel(stages=[SQLTransformer(statement="SELECT * FROM __THIS__")])


def direct(x, y, ids, cuts, weight, cfg):
    """The same trees, row by row: gradients of every node summed anew, every cut of every drawn feature tried."""
    margin, trees = np.zeros(len(x)), []
    for turn in range(cfg.max_iter):
        drawn = uniform(ids, cfg.seed, turn) < cfg.subsampling_rate
        columns = boosting.columns_of(turn, x.shape[1], cfg)
        p = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, weight, 1.0)
        g, h = w * (p - y), w * p * (1 - p)
        leaves = []

        def grow(rows, depth):
            use = rows[drawn[rows]]
            total_g, total_h = g[use].sum(), h[use].sum()
            best = (boosting.LEAST_GAIN, None)
            for j in columns if depth < cfg.max_depth else ():
                for cut in cuts[j]:
                    a = use[x[use, j] <= cut]
                    ga, ha = g[a].sum(), h[a].sum()
                    gb, hb = total_g - ga, total_h - ha
                    if min(ha, hb) < cfg.min_child_weight:
                        continue
                    gain = ga**2 / (ha + cfg.l2) + gb**2 / (hb + cfg.l2) - total_g**2 / (total_h + cfg.l2)
                    if gain > best[0] + 1e-9:
                        best = (gain, (j, cut))
            if best[1] is None:
                leaves.append((-cfg.step_size * total_g / (total_h + cfg.l2), total_h, rows))
                return
            j, cut = best[1]
            grow(rows[x[rows, j] <= cut], depth + 1)
            grow(rows[x[rows, j] > cut], depth + 1)

        grow(np.arange(len(x)), 0)
        for v, _, rows in leaves:
            margin[rows] += v
        trees.append(leaves)
    return margin, trees


def test_trees_equal_a_direct_computation(spark):
    df, cfg = table(spark), GBTConfig(max_iter=6, max_depth=3, step_size=0.3, bins=16)
    found = boosting.fit_boosted(df, plain(), NAMES, "y", cfg, "fold", 3)
    # the ids that sample rows are those of the stored blocks; rebuild them from the same rows in the same order
    numbers = F.array(*[F.col(n) for n in NAMES], F.col("y").cast("double"), F.col("fold").cast("double"))
    blocks = loaded(stored_blocks(df, numbers, "again")).collect()
    x, ids = np.concatenate([b.x for b in blocks]), np.concatenate([b.ids for b in blocks])
    cuts = boosting.fit_bins(df, NAMES, 16).cuts
    for model, without in zip(found, (None, 0, 1, 2)):
        use = x[:, 5] != without if without is not None else np.ones(len(x), bool)
        y = x[use, 4]
        margin, trees = direct(x[use, :4], y, ids[use], cuts, (y == 0).sum() / (y == 1).sum(), cfg)
        assert np.allclose(model.trees.margin(x[use, :4]), margin, atol=1e-6)
        for t, leaves in enumerate(trees):
            used = (model.trees.feature[t] < 0) & (model.trees.cover[t] > 0)
            assert np.allclose(sorted(model.trees.value[t][used]), sorted(v for v, h, _ in leaves if h > 0), atol=1e-7)
            assert model.trees.cover[t][0] == pytest.approx(sum(h for _, h, _ in leaves), abs=1e-5)


def test_fold_fits_equal_fits_alone_whatever_the_partitions(spark):
    df, cfg = table(spark), GBTConfig(max_iter=4, max_depth=2)
    rows = df.coalesce(1).cache()
    together = boosting.fit_boosted(rows, plain(), NAMES, "y", cfg, "fold", 3)
    again = boosting.fit_boosted(rows, plain(), NAMES, "y", cfg)[0]
    for a, b in zip((together[0].trees.feature, together[0].trees.value), (again.trees.feature, again.trees.value)):
        assert (a == b).all()


def test_the_driver_gets_splits_and_no_histograms(spark, monkeypatch):
    """However many tasks and bins: a few numbers per (fit, node) of each scan."""
    df, cfg, sent, collect = table(spark), GBTConfig(max_iter=3, max_depth=3, bins=64), [], RDD.collect
    blocks = loaded(boosting.training_blocks(df.repartition(12), NAMES, "y", "fold").repartition(12))
    binning = boosting.fit_bins(df, NAMES, cfg.bins)
    monkeypatch.setattr(RDD, "collect", lambda rdd: sent.append(collect(rdd)) or sent[-1])
    boosting.fit_trees(blocks, binning, 3, cfg)
    assert len(sent) > 3 and max(len(pickle.dumps(s)) for s in sent) < 4 * (1 << 2) * 8 * 8 + 1000


def test_constant_features_and_labels(spark):
    df = spark.createDataFrame([(1.0, float(i % 2), 1) for i in range(30)], "a double, b double, y int")
    m = boosting.fit_boosted(df, plain(), ("a", "b"), "y", GBTConfig(max_iter=3))[0]
    assert (m.trees.feature < 0).all() or m.trees.cover.max() > 0
    assert m.score(df).where("prob > 0.5 and prediction = 1").count() == 30


def test_better_than_sparks_trees_and_stored(spark, scratch):
    v = subscriber_view(spark, "/root/testdata/sf0.01")
    train, test = v.randomSplit([0.8, 0.2], 3)
    spec = fit_model_features(train, FIXTURE)
    cfg = GBTConfig(max_iter=30)
    ours = models.fit_boosted(train, spec, FIXTURE.label, cfg)
    theirs = models.fit_gbt(train, spec, FIXTURE.label, cfg)
    auc = lambda m: metrics.roc_auc(m.score(test), FIXTURE.label, "prob").first()["auc"]
    assert auc(ours) >= auc(theirs) - 0.01 and auc(ours) > 0.6
    save_model(ours, f"{scratch}/boosted")
    back = read_model(f"{scratch}/boosted")
    a = {r[FIXTURE.key]: r["prob"] for r in ours.score(test).collect()}
    assert a == {r[FIXTURE.key]: r["prob"] for r in back.score(test).collect()} and len(a) > 100


def test_contributions_add_up(spark):
    v = subscriber_view(spark, "/root/testdata/sf0.001")
    spec = fit_model_features(v, FIXTURE)
    m = models.fit_boosted(v, spec, FIXTURE.label, GBTConfig(max_iter=8))
    sv = models.shap_values(m, v, FIXTURE.key, "unused").join(m.score(v).select(FIXTURE.key, "prob"), FIXTURE.key)
    for r in sv.select((F.aggregate("shap", F.lit(0.0), lambda a, b: a + b) + F.col("base")).alias("s"), "prob").collect():
        assert math.isclose(r["s"], math.log(r["prob"] / (1 - r["prob"])), abs_tol=1e-9)
    x = np.random.default_rng(0).normal(size=(20, len(m.names)))
    phi, base = ensemble_shap(m.trees.for_shap(), x, 1.0)
    assert np.allclose(phi.sum(1) + base, m.trees.margin(x))
