"""The whole analysis on a small generated subscriber file (preset column names)."""

import numpy as np

from churnlens.plans.analysis import analyse_subscribers
from churnlens.schema import GBTConfig, SegmentConfig
from churnlens.sources.model_store import read_model

HEADER = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
          "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
          "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
          "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn"]


def write_fixture(path, n=300, seed=7):
    rng = np.random.default_rng(seed)
    yn = np.array(["Yes", "No"])
    contracts = np.array(["Month-to-month", "One year", "Two year"])
    internet = np.array(["DSL", "Fiber optic", "No"])
    pay = np.array(["Bank transfer (automatic)", "Credit card (automatic)", "Electronic check",
                    "Mailed check"])
    lines = [",".join(HEADER)]
    blanks = 0
    for i in range(n):
        tenure = int(rng.integers(0, 73))
        contract = contracts[rng.integers(0, 3)]
        net = internet[rng.integers(0, 3)]
        monthly = round(float(rng.uniform(18, 118)), 2)
        total = "" if tenure == 0 else f"{monthly * tenure:.2f}"
        blanks += tenure == 0
        p = 0.6 if contract == "Month-to-month" else 0.1
        p = p * (1.5 if tenure < 12 else 0.7)
        churn = "Yes" if rng.random() < min(p, 0.95) else "No"
        svc = lambda: "No internet service" if net == "No" else yn[rng.integers(0, 2)]
        row = [f"C{i:04d}", ["Male", "Female"][rng.integers(0, 2)], str(int(rng.random() < 0.16)),
               yn[rng.integers(0, 2)], yn[rng.integers(0, 2)], str(tenure), yn[rng.integers(0, 2)],
               yn[rng.integers(0, 2)], net, svc(), svc(), svc(), svc(), svc(), svc(), contract,
               yn[rng.integers(0, 2)], f'"{pay[rng.integers(0, 4)]}"', f"{monthly:.2f}",
               total if total else " ", churn]
        lines.append(",".join(row))
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return blanks


def test_analyse_subscribers(spark, scratch):
    csv = f"{scratch}/subscribers.csv"
    blanks = write_fixture(csv)
    out = analyse_subscribers(spark, csv, f"{scratch}/report",
                              segment_cfg=SegmentConfig(k_values=(2, 3), n_init=2, max_iter=50),
                              gbt_cfg=GBTConfig(max_iter=5, max_depth=3))
    read = lambda name: spark.read.parquet(out[name])
    lc = read("load_counts").first()
    assert (lc["rows_in"], lc["rows_dropped"]) == (300, blanks)
    assert read("k_sweep").count() == 2
    assert read("impact").count() == 4
    assert {r["metric"] for r in read("model_comparison").collect()} >= {"auc", "keep_linear"}
    assert read("shap_importance").count() == len(read_model(f"{scratch}/report/models/gbt").names)
    panels = {r["panel"] for r in read("executive_summary").collect()}
    assert panels == {"churn_share", "tenure", "contract", "model", "shap", "segment"}
    feats = read_model(f"{scratch}/report/models/logistic").names
    assert "Contract_One year" in feats and "Internet_Fiber optic" in feats and "gender_enc" in feats
    assert spark.read.parquet(out["segmented"]).count() == 300 - blanks
