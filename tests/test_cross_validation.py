"""Folds fitted together against separate fits; the registered cross-validation is that of the configured models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators import boosting, encode, folds, models, split
from churnlens.operators.blocks import loaded
from churnlens.plans import flows, queries
from churnlens.schema import FIXTURE, GBTConfig, LogisticConfig
from churnlens.sources.fixture_view import subscriber_view


def test_registered_folds_fit_the_configured_trees(spark, monkeypatch):
    asked = []

    class Nothing:
        folds = None

    monkeypatch.setattr(queries, "_FITS", {})
    monkeypatch.setattr(queries, "_run", lambda spark, sf_dir: None)
    monkeypatch.setattr(flows, "cross_validate", lambda run, cols, gbt_cfg=GBTConfig(): asked.append(gbt_cfg) or Nothing)
    queries.q_cv_auc(spark, "nowhere")
    assert asked == [GBTConfig()] and asked[0].max_iter == 300
    queries.q_cv_auc(spark, "nowhere")
    assert len(asked) == 1
    queries.release("nowhere")
    assert queries._FITS == {}


def newton(x, y, c):
    """One fit alone: balanced weights, own standardisation, 60 Newton steps."""
    n, pos = len(y), y.sum()
    std = x.std(0)
    z = np.hstack([np.where(std > 0, (x - x.mean(0)) / np.where(std > 0, std, 1), 0.0), np.ones((n, 1))])
    w = np.where(y == 1, n / (2 * pos), n / (2 * (n - pos)))
    ridge = np.append(np.full(x.shape[1], 1 / c), 0.0)
    beta = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ beta))
        beta = beta - np.linalg.lstsq((z * (w * p * (1 - p))[:, None]).T @ z + np.diag(ridge),
                                      z.T @ (w * (p - y)) + ridge * beta, rcond=1e-14)[0]
    return z @ beta


def test_logistic_folds_equal_separate_fits(spark):
    v = subscriber_view(spark, "/root/testdata/sf0.01")
    spec = encode.fit_model_features(v, FIXTURE)
    folded = split.assign_folds(v, FIXTURE.label, FIXTURE.key, 5).withColumn("constant", F.lit(3.0))
    encoded = models.feature_pipeline(spec).transform(folded)
    names = [*spec.names, "constant"]
    blocks = loaded(boosting.training_blocks(encoded, names, FIXTURE.label, "fold"))
    got = folds.fit_logistic_folds(blocks, {"baseline": 1e9, "ridge": 0.1}, 5)
    rows = np.concatenate(blocks.map(lambda b: b.x).collect())
    for (name, f), fit in got.items():
        x = rows[rows[:, -1] != f]
        want = newton(x[:, :-2], x[:, -2], {"baseline": 1e9, "ridge": 0.1}[name])
        assert np.allclose(fit.margin(x[:, :-2]), want, atol=1e-6), (name, f)
    # and Spark's own fit on the rows of one fold's complement
    rest = folded.where("fold <> 2")
    own = models.fit_logistic(rest, spec, FIXTURE.label, LogisticConfig(c=0.1, tol=1e-10))
    spark_fit = {r[FIXTURE.key]: r["prob"] for r in own.score(rest).collect()}
    numbers = encoded.where("fold <> 2").select(FIXTURE.key, *[F.col(f"`{n}`").cast("double") for n in names]).toPandas()
    mine = 1 / (1 + np.exp(-got["ridge", 2].margin(numbers[names].to_numpy())))
    assert np.allclose(mine, [spark_fit[k] for k in numbers[FIXTURE.key]], atol=1e-4)


def test_flow_scores_every_row_once_by_unseen_fits(spark):
    v = subscriber_view(spark, "/root/testdata/sf0.01")
    run = flows.prepare(v, FIXTURE)
    cfg = GBTConfig(max_iter=4, max_depth=2)
    cv = flows.cross_validate(run, FIXTURE, cfg)
    n = run.train.count()
    assert {r["model"]: r["count"] for r in cv.scores.groupBy("model").count().collect()} == dict.fromkeys(
        ("baseline", "ridge", "gbt"), n)
    rows = cv.folds.collect()
    assert len(rows) == 15 and all(0.5 < r["auc"] < 1 for r in rows)
    for r in queries._rank_auc(cv.scores, ["model", "fold"]).join(cv.folds, ["model", "fold"]).collect():
        assert r["by_rank"] == pytest.approx(r["auc"], abs=1e-12)
    alone = boosting.fit_boosted(run.train, models.feature_pipeline(run.spec), run.spec.names, FIXTURE.label, cfg)[0]
    assert alone.trees.feature.shape == cv.trees.trees.feature.shape
    summary = {r["model"]: r for r in models.cv_summary(cv.folds).collect()}
    assert summary["gbt"]["n_folds"] == 5
