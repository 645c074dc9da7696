"""Encodings, scaling, split and folds."""

import math

import pytest
from pyspark.sql import functions as F

from churnlens.operators import encode, split


def test_one_hot_drop_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "v string")
    oh = encode.fit_one_hot(df, [("v", "v")], 10, drop_first=True)
    assert oh.output_columns == ["v_b", "v_c"]
    rows = oh.transform(df).select("v", "v_b", "v_c").collect()
    got = {r["v"]: (r["v_b"], r["v_c"]) for r in rows}
    assert got == {"a": (0, 0), "b": (1, 0), "c": (0, 1), None: (0, 0)}
    full = encode.fit_one_hot(df, [("v", "v")], 10)
    assert all(sum(r[c] for c in full.output_columns) <= 1
               for r in full.transform(df).collect())


def test_one_hot_level_cap(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("v"))
    try:
        encode.fit_one_hot(df, [("v", "v")], max_levels=10)
    except ValueError:
        return
    raise AssertionError("cap not enforced")


def test_one_hot_counts_before_it_gathers_levels(spark, monkeypatch):
    df = spark.range(20).select(F.col("id").cast("string").alias("v"), F.lit("x").alias("w"))

    def gathered(*_):
        raise AssertionError("levels gathered before they were counted")

    monkeypatch.setattr(encode.F, "collect_list", gathered)
    with pytest.raises(ValueError, match="v has 20 levels"):
        encode.fit_one_hot(df, [("w", "w"), ("v", "v")], max_levels=10)


def test_population_scaling_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, k double")
    m = encode.fit_standard_scaler(df, ["a", "k"])
    assert math.isclose(m.stats[0][2], 1.247219128924647)
    out = m.transform(df).collect()
    assert all(r["k"] == 0.0 for r in out)
    assert math.isclose(sum(r["a"] for r in out), 0.0, abs_tol=1e-12)


def test_split_exact_per_class(spark):
    df = spark.range(1003).select(F.col("id").alias("key"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    s = split.stratified_split(df, "y", "key", 0.2, 42)
    counts = {(r["y"], r["is_test"]): r["count"] for r in s.groupBy("y", "is_test").count().collect()}
    n1, n0 = 251, 752
    assert counts[(1, 1)] == math.ceil(0.2 * n1) and counts[(0, 1)] == math.ceil(0.2 * n0)
    assert s.count() == 1003
    # deterministic and independent of partitioning
    s2 = split.stratified_split(df.repartition(3), "y", "key", 0.2, 42)
    assert sorted(r["key"] for r in s.where("is_test = 1").collect()) == \
        sorted(r["key"] for r in s2.where("is_test = 1").collect())


def test_folds_partition_rows(spark):
    df = spark.range(500).select(F.col("id").alias("key"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    f = split.assign_folds(df, "y", "key", 5, 7)
    sizes = {r["fold"]: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(sizes) == {0, 1, 2, 3, 4} and sum(sizes.values()) == 500
    assert max(sizes.values()) - min(sizes.values()) <= 2


def test_split_and_folds_follow_the_md5_order(spark):
    import hashlib

    rows = [(i, [None, 0, 1, 1, 1][i % 5]) for i in range(700)]
    df = spark.createDataFrame(rows, "key long, y int")
    by = {}
    for k, y in rows:
        by.setdefault(y, []).append((hashlib.md5(f"{k}:9".encode()).hexdigest(), k))
    test = {k for ks in by.values() for _, k in sorted(ks)[:math.ceil(0.2 * len(ks))]}
    fold = {k: i % 4 for ks in by.values() for i, (_, k) in enumerate(sorted(ks))}
    got = split.stratified_split(df, "y", "key", 0.2, 9)
    assert got.columns == ["key", "y", "is_test"] and got.count() == 700
    assert {r["key"] for r in got.where("is_test = 1").collect()} == test
    folds = split.assign_folds(df.where("y is not null"), "y", "key", 4, 9).collect()
    assert {r["key"]: r["fold"] for r in folds} == {k: f for k, f in fold.items() if rows[k][1] is not None}


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    w = split.class_weights(df, "y").first()
    assert (w["n_pos"], w["n_neg"], w["pos_weight"], w["w_pos"], w["w_neg"]) == (1, 3, 3.0, 2.0, 4 / 6)
