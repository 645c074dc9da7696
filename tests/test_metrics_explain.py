"""Metrics, AUC/ROC and explanation operators."""

import math

import numpy as np
from pyspark.sql import functions as F

from churnlens.operators import explain, metrics, segment


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_no_predicted_positives_gives_zero(spark):
    df = scored(spark, [(1, 0, 0.1), (0, 0, 0.2), (1, 0, 0.3)])
    m = metrics.threshold_metrics(df).first()
    assert (m["precision"], m["recall"], m["f1"]) == (0.0, 0.0, 0.0)
    cm = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 1, (0, 1): 0, (1, 0): 2, (1, 1): 0}


def test_auc_ties_and_symmetry(spark):
    tie = scored(spark, [(1, 0, 0.5), (0, 0, 0.5), (1, 0, 0.5), (0, 0, 0.5)])
    assert metrics.roc_auc(tie).first()["auc"] == 0.5
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300), 2)
    df = scored(spark, [(int(a), 0, float(b)) for a, b in zip(y, s)]).repartition(4)
    auc = metrics.roc_auc(df).first()["auc"]
    pos, neg = s[y == 1], s[y == 0]
    exact = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert math.isclose(auc, exact, rel_tol=1e-12)
    flipped = metrics.roc_auc(df.withColumn("score", 1 - F.col("score"))).first()["auc"]
    assert math.isclose(flipped, 1 - auc, rel_tol=1e-9)


def test_roc_curve_endpoints(spark):
    df = scored(spark, [(1, 0, 0.9), (0, 0, 0.8), (1, 0, 0.7), (0, 0, 0.1)])
    pts = metrics.roc_curve(df).orderBy(F.desc("threshold")).collect()
    assert (pts[0]["fpr"], pts[0]["tpr"]) == (0.0, 0.0)
    assert (pts[-1]["fpr"], pts[-1]["tpr"]) == (1.0, 1.0)


def test_pick_examples_fallback(spark):
    df = spark.createDataFrame([(3, 0.5), (1, 0.7), (2, 0.3)], "k long, p double")
    ex = {r["kind"]: (r["k"], r["p"]) for r in explain.pick_examples(df, "k", "p").collect()}
    assert ex == {"high": (1, 0.7), "low": (2, 0.3)}
    df2 = spark.createDataFrame([(5, 0.9), (4, 0.95), (9, 0.1)], "k long, p double")
    ex2 = {r["kind"]: r["k"] for r in explain.pick_examples(df2, "k", "p").collect()}
    assert ex2 == {"high": 4, "low": 9}


def test_top_in_row_and_top_abs(spark):
    df = spark.createDataFrame([(1, 0.5, -2.0, 1.0)], "k long, a double, b double, c double")
    df = df.withColumn("shap", F.array("a", "b", "c"))
    top = df.select(explain.top_in_row(["a", "b", "c"], "shap", 2).alias("t")).first()["t"]
    assert [t["feature"] for t in top] == ["b", "c"]
    coefs = spark.createDataFrame([("x", 0.3), ("y", -1.0), ("z", 0.1)], "feature string, coefficient double")
    assert [r["feature"] for r in explain.top_abs(coefs, "coefficient", 2).collect()] == ["y", "x"]


def test_crosstab_missing_cell_and_personas(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "s int, c string")
    ct = {r["s"]: r for r in segment.crosstab_pct(df, "s", "c", ["a", "b"]).collect()}
    assert ct[2]["n_b"] == 0 and ct[2]["pct_b"] == 0.0 and ct[1]["pct_a"] == 50.0
    prof = spark.createDataFrame([(1, 40.4), (2, 40.0), (3, 20.0), (4, 55.0)], "s int, churn_rate double")
    p = {r["s"]: r["persona"] for r in segment.assign_personas(prof).collect()}
    assert p == {1: "High Risk", 2: "Medium Risk", 3: "Low Risk", 4: "High Risk"}


def test_profile_rounds_twice(spark):
    # mean label 0.404 -> 0.40 -> 40.0 (whole-percent resolution)
    rows = [(1, 10, 1.0, 1.0, 0, 1 if i < 101 else 0) for i in range(250)]
    df = spark.createDataFrame(rows, "s int, t int, m double, tot double, sen int, y int")
    r = segment.profile_segments(df, "s", "t", "m", "tot", "sen", "y").first()
    assert r["churn_rate"] == 40.0
