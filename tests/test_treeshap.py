"""TreeSHAP: brute force on small random ensembles, additivity on a Spark GBT."""

import math

import numpy as np
from pyspark.sql import functions as F

from churnlens.operators import treeshap
from churnlens.operators.treeshap import LeafTables, Tree, ensemble_shap, tree_shap


def ensemble_margin(trees: list[Tree], x: np.ndarray, scale: float = 2.0) -> np.ndarray:
    return scale * sum(t.weight * t.predict(x) for t in trees)


def brute_force_shap(trees: list[Tree], x_row: np.ndarray, scale: float = 2.0) -> np.ndarray:
    """Exact Shapley values by subset enumeration (tests only, few features).

    The value of a subset S is the cover-weighted expectation of the tree
    output with features outside S marginalised along the tree's own paths.
    """
    from itertools import combinations
    from math import factorial

    n = x_row.shape[0]

    def cond_exp(tree: Tree, s: set) -> float:
        def go(j):
            if tree.left[j] < 0:
                return tree.value[j]
            f = tree.feature[j]
            a, b = tree.left[j], tree.right[j]
            if f in s:
                return go(a if x_row[f] <= tree.threshold[j] else b)
            return (tree.cover[a] * go(a) + tree.cover[b] * go(b)) / tree.cover[j]
        return go(0)

    def v(s):
        return scale * sum(t.weight * cond_exp(t, s) for t in trees)

    phi = np.zeros(n)
    for i in range(n):
        others = [k for k in range(n) if k != i]
        for size in range(n):
            for sub in combinations(others, size):
                s = set(sub)
                wgt = factorial(size) * factorial(n - size - 1) / factorial(n)
                phi[i] += wgt * (v(s | {i}) - v(s))
    return phi


def random_tree(rng, depth, n_features):
    left, right, feat, thr, val, cov = [], [], [], [], [], []

    def build(d, c):
        i = len(left)
        left.append(-1), right.append(-1), feat.append(-1), thr.append(0.0)
        val.append(float(rng.normal())), cov.append(c)
        if d < depth:
            feat[i] = int(rng.integers(n_features))
            thr[i] = float(rng.normal())
            cl = c * float(rng.uniform(0.2, 0.8))
            a = build(d + 1, cl)
            b = build(d + 1, c - cl)
            left[i], right[i] = a, b
        return i

    build(0, 100.0)
    return Tree(np.array(left), np.array(right), np.array(feat), np.array(thr), np.array(val),
                np.array(cov), float(rng.uniform(0.05, 1.0)))


def test_matches_brute_force_and_adds_up():
    rng = np.random.default_rng(0)
    for _ in range(4):
        trees = [random_tree(rng, 4, 4) for _ in range(3)]
        x = rng.normal(size=(16, 4))
        phi, base = ensemble_shap(trees, x)
        assert np.allclose(phi.sum(1) + base, ensemble_margin(trees, x))
        for r in range(4):
            assert np.allclose(brute_force_shap(trees, x[r]), phi[r])


def test_leaf_tables_equal_the_recursion(monkeypatch):
    rng = np.random.default_rng(7)
    for depth, features in ((1, 3), (4, 2), (5, 9), (6, 4)):
        for _ in range(3):
            tree = random_tree(rng, depth, features)
            x = rng.normal(size=(40, features))
            phi = np.zeros(x.shape)
            assert LeafTables.fits(tree)
            LeafTables(tree).add(x, phi, 1.0)
            assert np.allclose(phi, tree_shap(tree, x))
    stump = Tree(np.array([-1]), np.array([-1]), np.array([-1]), np.zeros(1), np.array([2.0]), np.array([9.0]))
    assert ensemble_shap([stump], np.zeros((3, 2)), 1.0)[0].tolist() == [[0.0, 0.0]] * 3
    monkeypatch.setattr(treeshap, "TABLE_FEATURES", 2)
    tree = random_tree(rng, 5, 6)
    x = rng.normal(size=(10, 6))
    assert not LeafTables.fits(tree)
    assert np.allclose(ensemble_shap([tree], x, 1.0)[0], tree.weight * tree_shap(tree, x))


def test_spark_gbt_additivity(spark):
    from churnlens.operators import models
    from churnlens.operators.encode import fit_model_features
    from churnlens.schema import FIXTURE, GBTConfig
    from churnlens.session import ensure_checkpoint_dir
    from churnlens.sources.fixture_view import subscriber_view

    v = subscriber_view(spark, "/root/testdata/sf0.001")
    spec = fit_model_features(v, FIXTURE)
    m = models.fit_gbt(v, spec, FIXTURE.label, GBTConfig(max_iter=5, max_depth=3))
    sv = models.shap_values(m, v, FIXTURE.key, ensure_checkpoint_dir(spark))
    probs = m.score(v).select(FIXTURE.key, "prob")
    rows = sv.join(probs, FIXTURE.key).select(
        (F.aggregate("shap", F.lit(0.0), lambda a, b: a + b) + F.col("base")).alias("s"), "prob").collect()
    for r in rows:
        p = min(max(r["prob"], 1e-12), 1 - 1e-12)
        assert math.isclose(r["s"], math.log(p / (1 - p)), abs_tol=1e-6)


def test_coefficient_and_shap_signs_agree(spark):
    """Tenure lowers churn in both models: negative coefficient, SHAP falling with tenure."""
    from churnlens.operators import models
    from churnlens.operators.encode import fit_model_features
    from churnlens.schema import FIXTURE, GBTConfig
    from churnlens.session import ensure_checkpoint_dir
    from churnlens.sources.fixture_view import subscriber_view

    v = subscriber_view(spark, "/root/testdata/sf0.01")
    spec = fit_model_features(v, FIXTURE)
    lr = models.fit_logistic(v, spec, FIXTURE.label)
    coef = dict(zip(spec.names, lr.estimator.coefficients.toArray()))
    gbt = models.fit_gbt(v, spec, FIXTURE.label, GBTConfig(max_iter=20, max_depth=3))
    sv = models.shap_values(gbt, v, FIXTURE.key, ensure_checkpoint_dir(spark))
    i = list(spec.names).index("tenure")
    r = sv.select(F.corr("tenure", F.col("shap")[i]).alias("r")).first()["r"]
    assert coef["tenure"] < 0 and r < 0
