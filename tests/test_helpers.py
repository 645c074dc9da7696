"""Hash split, key-checked attach, bounded ROC."""

import pytest
from pyspark.sql import functions as F

from churnlens.operators import joins, metrics, split


def test_hash_split_is_deterministic_and_close(spark):
    df = spark.range(20000).select(F.col("id").alias("key"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    a = split.stratified_split(df, "y", "key", 0.2, 42, method="hash")
    b = split.stratified_split(df.repartition(7), "y", "key", 0.2, 42, method="hash")
    share = {r["y"]: r["s"] for r in a.groupBy("y").agg(F.avg("is_test").alias("s")).collect()}
    assert all(abs(v - 0.2) < 0.02 for v in share.values())
    ka = {r["key"] for r in a.where("is_test = 1").collect()}
    kb = {r["key"] for r in b.where("is_test = 1").collect()}
    assert ka == kb


def test_attach_by_key_checks_uniqueness(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    good = spark.createDataFrame([(1, 10), (2, 20)], "k long, s int")
    assert joins.attach_by_key(left, good, "k").count() == 2
    bad = spark.createDataFrame([(1, 10), (1, 11)], "k long, s int")
    with pytest.raises(ValueError):
        joins.attach_by_key(left, bad, "k")


def test_scores_that_are_no_number_are_left_out(spark):
    rows = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.5), (1, None), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, score double")
    assert metrics.roc_auc(df).first()["auc"] == 0.75
    curve = {r["threshold"]: (r["fpr"], r["tpr"]) for r in metrics.roc_curve(df).collect()}
    assert curve == {float("inf"): (0.0, 0.0), 0.9: (0.0, 0.5), 0.5: (0.5, 0.5), 0.4: (0.5, 1.0), 0.1: (1.0, 1.0)}


def test_models_are_measured_in_one_table(spark):
    df = spark.createDataFrame([(1, 1, 0.9, 0, 0.2), (0, 0, 0.1, 1, 0.8), (1, 0, 0.4, 1, None)],
                               "label int, p1 int, s1 double, p2 int, s2 double")
    t = metrics.metric_tables(df, "label", {"a": ("p1", "s1"), "b": ("p2", "s2")})
    got = {(r["model"], r["metric"]): r["value"] for r in t.collect()}
    assert got["a", "auc"] == 1.0 and got["b", "auc"] == 0.0 and got["a", "recall"] == 0.5 and got["b", "precision"] == 0.5
    pair = {r["metric"]: r["delta"] for r in metrics.compare_models(t, "a", "b").collect()}
    assert pair["auc"] == -1.0 and pair["keep_linear"] == 0.0


def test_a_cluster_needs_a_shared_folder():
    from churnlens import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_roc_score_rounding_bounds_points(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("label"),
                                  (F.col("id") / 1000.0).alias("score"))
    full = metrics.roc_curve(df).count()
    coarse = metrics.roc_curve(df, score_decimals=1).collect()
    assert full == 1001 and len(coarse) <= 12
    last = max(coarse, key=lambda r: (r["fpr"], r["tpr"]))
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)
