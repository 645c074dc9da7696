"""Logistic ridge parity with a Newton solve, model save/load, sources."""

import math

import numpy as np
from pyspark.sql import functions as F

from churnlens.operators import encode, models
from churnlens.schema import FIXTURE, LogisticConfig
from churnlens.sources.fixture_view import subscriber_view
from churnlens.sources.model_store import read_model, save_model
from churnlens.sources.subscribers import load_subscribers, read_segmented, write_segmented

C = FIXTURE


def newton_ridge(x, y, w, c, iters=50):
    """scikit-learn objective: C * sum(w * logloss) + ||b||^2 / 2, intercept free."""
    n, d = x.shape
    xa = np.hstack([x, np.ones((n, 1))])
    beta = np.zeros(d + 1)
    pen = np.eye(d + 1) / c
    pen[-1, -1] = 0.0
    for _ in range(iters):
        p = 1 / (1 + np.exp(-xa @ beta))
        g = xa.T @ (w * (p - y)) + pen @ beta
        h = (xa * (w * p * (1 - p))[:, None]).T @ xa + pen
        beta -= np.linalg.solve(h, g)
    return beta


def test_ridge_matches_newton(spark):
    v = subscriber_view(spark, "/root/testdata/sf0.01")
    spec = encode.fit_model_features(v, C)
    m = models.fit_logistic(v, spec, C.label, LogisticConfig(c=0.1, tol=1e-10))
    enc = spec.transform(v)
    scaler = encode.fit_standard_scaler(enc, list(spec.names))
    pdf = scaler.transform(enc).select(*spec.names, C.label).toPandas()
    x = pdf[list(spec.names)].to_numpy(float)
    y = pdf[C.label].to_numpy(float)
    n, npos = len(y), y.sum()
    w = np.where(y == 1, n / (2 * npos), n / (2 * (n - npos)))
    beta = newton_ridge(x, y, w, 0.1)
    got = np.append(m.estimator.coefficients.toArray(), m.estimator.intercept)
    assert np.allclose(got, beta, atol=1e-4), np.abs(got - beta).max()


def test_model_save_load_same_scores(spark, scratch):
    v = subscriber_view(spark, "/root/testdata/sf0.001")
    spec = encode.fit_model_features(v, C)
    m = models.fit_logistic(v, spec, C.label)
    save_model(m, f"{scratch}/lr")
    m2 = read_model(f"{scratch}/lr")
    a = {r[C.key]: r["prob"] for r in m.score(v).collect()}
    b = {r[C.key]: r["prob"] for r in m2.score(v).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[k], b[k]) for k in a)
    assert m2.names == m.names


def test_csv_scan_clean_and_segmented_round_trip(spark, scratch):
    header = ("customerID,gender,SeniorCitizen,Partner,Dependents,tenure,PhoneService,MultipleLines,"
              "InternetService,OnlineSecurity,OnlineBackup,DeviceProtection,TechSupport,StreamingTV,"
              "StreamingMovies,Contract,PaperlessBilling,PaymentMethod,MonthlyCharges,TotalCharges,Churn")
    rows = [
        "A-1,Male,0,Yes,No,1,No,No phone service,DSL,No,Yes,No,No,No,No,Month-to-month,Yes,Electronic check,29.85,29.85,No",
        "B-2,Female,1,No,No,0,Yes,No,Fiber optic,No,No,No,No,No,No,Two year,No,Mailed check,56.95, ,No",
        "C-3,Male,0,No,No,2,Yes,No,DSL,Yes,Yes,No,No,No,No,Month-to-month,Yes,Mailed check,53.85,108.15,Yes",
    ]
    path = f"{scratch}/subs.csv"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(header + "\n" + "\n".join(rows) + "\n")
    df, obs = load_subscribers(spark, path)
    got = {r["customerID"]: (r["TotalCharges"], r["Churn_binary"]) for r in df.collect()}
    assert got == {"A-1": (29.85, 0), "C-3": (108.15, 1)}
    assert obs.get["rows_dropped"] == 1 and obs.get["rows_in"] == 3
    write_segmented(df.withColumn("Cluster", F.lit(1)), f"{scratch}/seg")
    back, obs2 = read_segmented(spark, f"{scratch}/seg")
    assert back.count() == 2 and obs2.get["rows_dropped"] == 0


def test_scoring_after_observation(spark):
    """A model fitted in a session that used an Observation still scores."""
    from churnlens.operators import clean
    df = spark.createDataFrame([("1",), (" ",)], "t string")
    kept, obs = clean.drop_missing(clean.coerce_numeric(df, "t"), ["t"])
    kept.write.format("noop").mode("overwrite").save()
    v = subscriber_view(spark, "/root/testdata/sf0.001")
    spec = encode.fit_model_features(v, C)
    m = models.fit_logistic(v, spec, C.label)
    assert m.score(v).where(F.col("prob").between(0, 1)).count() == v.count()
