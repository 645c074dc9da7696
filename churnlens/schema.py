"""Source schema, column presets and fixed analysis parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Subscriber file schema (21 columns).  TotalCharges stays text so that
# blanks and rejects can be counted before coercion.
SUBSCRIBER_SCHEMA = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("SeniorCitizen", T.IntegerType()),
    T.StructField("Partner", T.StringType()),
    T.StructField("Dependents", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("PhoneService", T.StringType()),
    T.StructField("MultipleLines", T.StringType()),
    T.StructField("InternetService", T.StringType()),
    T.StructField("OnlineSecurity", T.StringType()),
    T.StructField("OnlineBackup", T.StringType()),
    T.StructField("DeviceProtection", T.StringType()),
    T.StructField("TechSupport", T.StringType()),
    T.StructField("StreamingTV", T.StringType()),
    T.StructField("StreamingMovies", T.StringType()),
    T.StructField("Contract", T.StringType()),
    T.StructField("PaperlessBilling", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.StringType()),
    T.StructField("Churn", T.StringType()),
])

# --- Fixed values that results depend on (must stay as written) -----------
# Tenure bins, right-closed, and their labels.
TENURE_EDGES_6 = [0, 12, 24, 36, 48, 60, 72]
TENURE_LABELS_6 = ["1-12mo (New)", "13-24mo (Early)", "25-36mo (Mid)",
                   "37-48mo (Stable)", "49-60mo (Long)", "61-72mo (Loyal)"]
TENURE_EDGES_4 = [0, 12, 24, 36, 72]
TENURE_LABELS_4 = ["1-12mo (New)", "13-24mo (Early)", "25-36mo (Mid)", "37mo+ (Long)"]
# Persona bands on the rounded segment churn rate (percent), strict '>'.
PERSONA_BANDS = [(40.0, "High Risk"), (20.0, "Medium Risk")]
PERSONA_DEFAULT = "Low Risk"
PERSONA_ACTIONS = {
    "High Risk": "Strengthen onboarding and early-tenure care",
    "Medium Risk": "Offer annual-payment discount and retention offer",
    "Low Risk": "Loyalty programme and add-on upselling",
}
# What the model features of the subscriber file stand for, shown beside the top ones.
FEATURE_MEANINGS = {
    "tenure": "length of the contract so far; longer customers stay",
    "Contract_Two year": "bound for two years; the strongest tie",
    "Contract_One year": "bound for one year; a medium tie",
    "MonthlyCharges": "monthly price; a higher one raises the risk",
    "TotalCharges": "paid so far; goes along with tenure",
    "Internet_Fiber optic": "premium line; such customers switch easily",
    "Internet_No": "no online service; steady customers",
    "OnlineSecurity_enc": "security add-on; lowers the risk",
    "TechSupport_enc": "uses support; complaints get settled",
    "PaperlessBilling_enc": "bills online; compares offers more",
}
# The same for the view over the driver's tables.
VIEW_MEANINGS = {
    "tenure": "months between first and last order",
    "monthly_charges": "mean price of an order",
    "total_charges": "sum of all orders",
    "senior": "negative account balance",
}
# Keep the linear model when the boosted model gains less AUC than this.
AUC_MARGIN = 0.02
# Exemplar thresholds on predicted churn probability.
HIGH_RISK_P = 0.8
LOW_RISK_P = 0.2
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class SubscriberColumns:
    """Column roles; the default is the subscriber-file preset."""

    key: str = "customerID"
    label_text: str = "Churn"
    label: str = "Churn_binary"
    tenure: str = "tenure"
    monthly: str = "MonthlyCharges"
    total: str = "TotalCharges"
    senior: str = "SeniorCitizen"
    contract: str = "Contract"
    segment: str = "Cluster"
    numeric: tuple[str, ...] = ("tenure", "MonthlyCharges", "TotalCharges", "SeniorCitizen")
    # Yes/No (or Yes/No/"no service") flags encoded 1 iff "Yes".
    model_flags: tuple[str, ...] = (
        "Partner", "Dependents", "PhoneService", "PaperlessBilling", "MultipleLines",
        "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
        "StreamingTV", "StreamingMovies")
    # (column, value) pairs encoded 1 iff equal.
    model_equals: tuple[tuple[str, str], ...] = (("gender", "Male"),)
    # (column, prefix) one-hot with the first level dropped.
    model_onehot: tuple[tuple[str, str], ...] = (
        ("Contract", "Contract"), ("InternetService", "Internet"), ("PaymentMethod", "Payment"))
    cluster_flags: tuple[str, ...] = ("PaperlessBilling", "PhoneService", "Partner", "Dependents")
    # (column, prefix) one-hot with all levels.
    cluster_onehot: tuple[tuple[str, str], ...] = (
        ("Contract", "Contract"), ("InternetService", "Internet"))
    rate_columns: tuple[str, ...] = (
        "Contract", "InternetService", "PaymentMethod", "PaperlessBilling",
        "TechSupport", "OnlineSecurity")
    month_to_month: str = "Month-to-month"
    # Accepted width of a one-hot column; more levels are refused.
    max_levels: int = 1000


SUBSCRIBER = SubscriberColumns()

# Preset for the subscriber view derived from the driver's tables
# (see churnlens.sources.fixture_view).
FIXTURE = SubscriberColumns(
    key="customer_id", label_text="churn", label="churn_binary", tenure="tenure",
    monthly="monthly_charges", total="total_charges", senior="senior",
    contract="contract", segment="segment",
    numeric=("tenure", "monthly_charges", "total_charges", "senior"),
    model_flags=("paperless", "urgent", "high_value"),
    model_equals=(("priority", "1-URGENT"),),
    model_onehot=(("contract", "contract"), ("region", "region")),
    cluster_flags=("paperless", "urgent"),
    cluster_onehot=(("contract", "contract"), ("region", "region")),
    rate_columns=("contract", "region", "priority", "paperless", "urgent", "high_value"),
    month_to_month="BUILDING",
)


@dataclass(frozen=True)
class ImpactConfig:
    """Parameters of the retention-initiative estimate (defaults as published)."""

    new_tenure_max: int = 12
    onboarding_rate_now: float = 0.477
    onboarding_rate_target: float = 0.350
    conversion_share: float = 0.15
    conversion_rate_now: float = 0.427
    conversion_rate_after: float = 0.113
    addon_uptake: float = 0.20
    addon_rate_now: float = 0.418
    addon_rate_after: float = 0.146
    months: int = 12


@dataclass(frozen=True)
class GBTConfig:
    max_iter: int = 300
    max_depth: int = 4
    step_size: float = 0.05
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"   # of Spark's own trees: features drawn per node
    column_share: float = 0.8     # of the second-order trees: features drawn per tree
    bins: int = 256
    l2: float = 1.0
    min_child_weight: float = 1.0
    min_gain: float = 0.0
    seed: int = 42


@dataclass(frozen=True)
class LogisticConfig:
    c: float = 0.1           # inverse penalty strength, scikit-learn convention
    max_iter: int = 1000
    tol: float = 1e-6


@dataclass(frozen=True)
class SegmentConfig:
    k_values: tuple[int, ...] = tuple(range(2, 9))
    n_init: int = 10
    max_iter: int = 300
    tol: float = 1e-4
    seed: int = 42


@dataclass(frozen=True)
class SplitConfig:
    test_fraction: float = 0.2
    n_folds: int = 5
    seed: int = 42
