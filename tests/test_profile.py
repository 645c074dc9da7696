"""Profiles, quantiles, rates and statistics against hand values and pandas."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from churnlens.operators import clean, comoments, profile, ranking, rates, stats
from churnlens.operators.ranking import exact_quantiles, running_sums
from churnlens.operators.sketches import RANK_ERROR, column_summaries, merge_summaries, sketched_quantiles


def test_quartile_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    q = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).first()
    assert (q["q_25"], q["q_50"], q["q_75"]) == (1.75, 2.5, 4.75)


def test_quantiles_match_numpy_under_repartition(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.normal(size=997), 1)  # many ties
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(7)
    q = exact_quantiles(df, ["x"], [0.1, 0.5, 0.9]).first()
    for p, tag in [(0.1, "q_10"), (0.5, "q_50"), (0.9, "q_90")]:
        assert math.isclose(q[tag], float(np.quantile(vals, p)), abs_tol=1e-12)


def test_quantiles_hold_with_coarse_sketches(spark):
    """Sketches of eight values err a lot: brackets miss and are widened, the quantiles stay exact."""
    rng = np.random.default_rng(2)
    a = rng.normal(size=9000)
    b = np.where(rng.random(9000) < 0.4, 7.0, np.round(rng.exponential(size=9000), 2))  # a third ties
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)]
                               + [(float("nan"), None, None)], "a double, b double, none double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.6, 0.99, 1.0]
    for k in (8, 200):
        rows = {r["variable"]: r for r in exact_quantiles(df, ["a", "b", "none"], probs, k=k).collect()}
        for name, values in (("a", a), ("b", b)):
            for p in probs:
                assert math.isclose(rows[name][f"q_{round(p * 100):02d}"], float(np.quantile(values, p)), abs_tol=1e-12)
        assert all(rows["none"][f"q_{round(p * 100):02d}"] is None for p in probs)


def test_missed_brackets_are_widened(spark, monkeypatch):
    values = np.random.default_rng(5).normal(size=3000)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    reaches, original = [], ranking._values_at
    monkeypatch.setattr(ranking, "MARGIN", 1e-6)

    def watched(*args):
        reaches.append(args[-1])
        return original(*args)

    monkeypatch.setattr(ranking, "_values_at", watched)
    q = exact_quantiles(df, ["x"], [0.3, 0.7], k=8).first()
    assert math.isclose(q["q_30"], float(np.quantile(values, 0.3)), abs_tol=1e-12) and len(reaches) > 1


def test_summaries_merge_without_a_rescan(spark):
    rng = np.random.default_rng(3)
    old, new = rng.normal(5, 2, size=4000), rng.exponential(size=3000) + 1e6
    frame = lambda v: spark.createDataFrame([(float(x), None) for x in v], "x double, none double").repartition(4)
    merged = merge_summaries(column_summaries(frame(old), ["x", "none"]), column_summaries(frame(new), ["x", "none"]))
    rows = {r["variable"]: r for r in merged.collect()}
    both = np.concatenate([old, new])
    assert rows["x"]["n"] == 7000 and math.isclose(rows["x"]["mean"], both.mean()) and rows["x"]["max"] == both.max()
    assert math.isclose(rows["x"]["m2"], ((both - both.mean()) ** 2).sum(), rel_tol=1e-9)
    assert rows["none"]["n"] == 0 and rows["none"]["min"] is None
    got = sketched_quantiles(merged, [0.1, 0.5, 0.9]).collect()
    assert [r["variable"] for r in got] == ["x"]
    order = np.sort(both)
    for p, v in zip((0.1, 0.5, 0.9), got[0]["q"]):
        assert abs(np.searchsorted(order, v) / 7000 - p) < 4 * RANK_ERROR
    d = profile.describe(frame(both), ["x", "none"], None, merged).where("variable = 'x'").first()
    assert math.isclose(d["p50"], float(np.median(both))) and math.isclose(d["std"], both.std(ddof=1), rel_tol=1e-9)


def test_running_sums(spark):
    pdf = pd.DataFrame({"g": [i % 3 for i in range(200)], "k": list(range(200)),
                        "v": [float(i % 7) for i in range(200)]})
    df = spark.createDataFrame(pdf).repartition(5)
    out = running_sums(df, "k", ["v"], ["g"], slices=6).toPandas().sort_values("k")
    exp = pdf.sort_values("k").groupby("g")["v"].cumsum()
    assert np.allclose(out["v_cum"].to_numpy(), exp.to_numpy())
    back = running_sums(df, "k", ["v"], ["g"], slices=4, descending=True).toPandas().sort_values("k")
    exp = pdf.sort_values("k", ascending=False).groupby("g")["v"].cumsum().sort_index()
    assert np.allclose(back["v_cum"].to_numpy(), exp.to_numpy())


def test_drop_missing_counts(spark):
    df = spark.createDataFrame([("1",), (" ",), ("x",), ("3.5",)], "t string")
    kept, obs = clean.drop_missing(clean.coerce_numeric(df, "t"), ["t"])
    assert kept.count() == 2
    assert obs.get["rows_in"] == 4 and obs.get["rows_dropped"] == 2


def test_missing_and_value_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, "a")], "a int, b string")
    m = {r["column"]: r["n_missing"] for r in profile.missing_counts(df).collect()}
    assert m == {"a": 1, "b": 1}
    vc = profile.value_counts(df, "b").collect()
    assert vc[0]["value"] == "a" and vc[0]["n"] == 2 and math.isclose(vc[0]["pct"], 200 / 3)


def test_rate_by_drops_null_level_keeps_baseline(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "c string, y int")
    rows = {r["level"]: r for r in rates.rate_by(df, "c", "y").collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"]["churn_rate"] == 50.0 and rows["b"]["churn_rate"] == 100.0
    assert rows["a"]["baseline"] == 75.0


def test_rate_by_bin_empty_bins_absent(spark):
    df = spark.createDataFrame([(0, 1), (5, 1), (30, 0), (80, 1)], "t int, y int")
    got = rates.rate_by_bin(df, "t", [0, 12, 24, 36, 72], ["a", "b", "c", "d"], "y").collect()
    assert [(r["bin_idx"], r["n"], r["churn_rate"]) for r in got] == [(1, 1, 100.0), (3, 1, 0.0)]


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0), (2.0, 5.0, 4.1), (3.0, 5.0, 5.9)], "a double, b double, c double")
    r = {(x["x"], x["y"]): x["r"] for x in stats.correlation(df, ["a", "b", "c"]).collect()}
    assert r[("a", "b")] is None
    assert math.isclose(r[("a", "c")], float(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]))


def test_kde_prebin_keeps_its_error_bound(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(0, float(x)) for x in rng.normal(size=400)], "c int, x double")
    h = df.toPandas()["x"].std() * 400 ** -0.2
    exact = stats.kde(df, "x", "c", points=60).orderBy("point").toPandas()
    coarse = stats.kde(df, "x", "c", points=60, prebin=0.02).orderBy("point").toPandas()
    # the grid moves with the rounded ends; compare at the exact grid's points
    near = np.interp(exact["x"], coarse["x"], coarse["density"])
    assert np.abs(near - exact["density"]).max() <= 0.121 * 0.02 / h**2 + 0.01


def test_kde_matches_formula(spark):
    xs = [1.0, 2.0, 2.0, 3.5, 7.0]
    df = spark.createDataFrame([(0, x) for x in xs], "c int, x double")
    out = stats.kde(df, "x", "c", points=50).orderBy("point").toPandas()
    n, sd = len(xs), float(np.std(xs, ddof=1))
    h = sd * n ** (-0.2)
    lo, hi = min(xs) - 0.5 * (max(xs) - min(xs)), max(xs) + 0.5 * (max(xs) - min(xs))
    grid = np.linspace(lo, hi, 50)
    dens = np.exp(-0.5 * ((grid[:, None] - np.array(xs)[None, :]) / h) ** 2).sum(1) / (n * h * np.sqrt(2 * np.pi))
    assert np.allclose(out["density"].to_numpy(), dens, rtol=1e-9)
    assert len(out) == 50


def test_comoments_match_pandas_pairwise_and_add_up(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 5)) @ rng.normal(size=(5, 5)) + 1e6 * np.arange(5)
    x[rng.random(x.shape) < 0.1] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcde"))
    pdf["constant"] = 3.3
    rows = [tuple(None if i % 2 and math.isnan(v) else float(v) for v in r) for i, r in enumerate(pdf.to_numpy())]
    frame = lambda rs: spark.createDataFrame(rs, ", ".join(f"{c} double" for c in pdf.columns)).repartition(3)
    table = comoments.comoments(frame(rows), list(pdf.columns))
    want, cov = pdf.corr(), pdf.cov()
    got = {(r["x"], r["y"]): r["r"] for r in comoments.pearson(table).collect()}
    assert len(got) == 36
    for (a, b), r in got.items():
        if "constant" in (a, b):
            assert r is None
        else:
            assert math.isclose(r, want.loc[a, b], abs_tol=1e-9)
    for r in comoments.covariances(table).collect():
        assert math.isclose(r["covariance"], cov.loc[r["x"], r["y"]], rel_tol=1e-7, abs_tol=1e-9)
    centers = [table.where(f"x = '{c}' and y = '{c}'").first()["cx"] for c in pdf.columns]
    parts = [comoments.comoments(frame(part), list(pdf.columns), centers) for part in (rows[:250], rows[250:])]
    again = {(r["x"], r["y"]): r["r"] for r in comoments.pearson(comoments.added(*parts)).collect()}
    assert all(again[k] == got[k] or math.isclose(again[k], got[k], abs_tol=1e-9) for k in got)
    whole = pdf.dropna().drop(columns="constant")
    mean, loadings, shares = comoments.components(comoments.comoments(frame([tuple(map(float, r)) + (0.0,) for r in whole.to_numpy()]),
                                                                      list("abcde")))
    values = np.sort(np.linalg.eigvalsh(whole.cov()))[::-1]
    assert np.allclose(mean, whole.mean()) and np.allclose(shares, values[:2] / values.sum(), atol=1e-9)
    scores = (whole.to_numpy() - mean) @ loadings
    assert np.allclose(np.cov(scores.T), np.diag(values[:2]), atol=1e-6)
    empty = comoments.pearson(comoments.comoments(frame(rows).limit(0), ["a", "b"])).collect()
    assert all(r["r"] is None for r in empty)


def test_binned_density_keeps_its_bound(spark):
    rng = np.random.default_rng(9)
    rows = [(float(v), "ab"[i % 2]) for i, v in enumerate(np.concatenate([rng.normal(size=900), rng.exponential(5, 300)]))]
    df = spark.createDataFrame(rows + [(None, "a"), (float("nan"), "b")], "v double, c string")
    for points in (1000, 80):
        exact = {(r["class"], r["point"]): r["density"] for r in stats.kde(df, "v", "c", points).collect()}
        got = stats.binned_kde(df, "v", "c", points).collect()
        assert len(got) == len(exact) == 2 * points
        assert max(r["error"] for r in got) < (0.02 if points == 1000 else 1.0)
        for r in got:
            assert abs(r["density"] - exact[r["class"], r["point"]]) <= r["error"] + 1e-12
