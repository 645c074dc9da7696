"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All read the driver's tables (or the subscriber view Spark derives from them)
in full; none filters rows to make a check cheaper.  Measures that depend on
floating-point summation order are rounded to 6 decimals here and in the
DuckDB twins (``churnlens.plans.oracle``) so both engines agree.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.functions import binarize
from churnlens.operators import (clean, encode, explain, impact, joins, metrics, profile, rates,
                                 segment, split, stats)
from churnlens.operators.silhouette import euclidean_silhouette
from churnlens.operators.sketches import column_summaries, merge_summaries
from churnlens.schema import (FIXTURE, GBTConfig, TENURE_EDGES_4, TENURE_EDGES_6, TENURE_LABELS_4,
                              TENURE_LABELS_6, VIEW_MEANINGS)
from churnlens.session import ensure_checkpoint_dir, materialize
from churnlens.sources.fixture_view import read_table, subscriber_view
from churnlens.sources.subscribers import read_with_rejects, write_report

C = FIXTURE


def r6(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)


def _round_cols(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})


# --- rates ---------------------------------------------------------------

def q_tenure_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    return _round_cols(rates.rate_by_bin(v, C.tenure, TENURE_EDGES_6, TENURE_LABELS_6, C.label),
                       ["churn_rate"])


def q_tenure_rates_4bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    return _round_cols(rates.rate_by_bin(v, C.tenure, TENURE_EDGES_4, TENURE_LABELS_4, C.label),
                       ["churn_rate"])


def q_contract_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    return _round_cols(rates.rate_by(v, C.contract, C.label), ["churn_rate", "baseline", "lift"])


def q_multi_column_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    return _round_cols(rates.rate_by(v, list(C.rate_columns), C.label),
                       ["churn_rate", "baseline", "lift"])


def q_lineitem_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return share (flag 'R') per line status and discount level of every line item."""
    li = read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        "l_linestatus", F.col("l_discount").cast("string").alias("l_discount"),
        F.col("l_tax").cast("string").alias("l_tax"))
    return _round_cols(rates.rate_by(li, ["l_linestatus", "l_discount", "l_tax"], "returned"),
                       ["churn_rate", "baseline", "lift"])


def q_overall_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    return _round_cols(rates.overall_rate(v, C.label), ["churn_rate"])


def q_rate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    return _round_cols(rates.rate_summary(v, C.tenure, TENURE_EDGES_4, TENURE_LABELS_4, C.label,
                                          [C.contract, "paperless"]), ["churn_rate"])


# --- cleaning and profiles ------------------------------------------------

def events_with_text_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose amount arrives as text; sign-ups carry a blank amount.

    This mirrors a subscriber file where new customers have no total yet.
    """
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", "event_type",
                     F.when(F.col("event_type") == "signup", F.lit(" "))
                      .otherwise(F.col("value").cast("string")).alias("charges"))


def q_coerce_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = clean.coerce_numeric(events_with_text_charges(spark, sf_dir), "charges")
    kept, _ = clean.drop_missing(ev, ["charges"])
    return kept.select("event_id", "user_id", "charges",
                       binarize("event_type", "error").alias("is_error"))


def q_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = clean.coerce_numeric(events_with_text_charges(spark, sf_dir), "charges")
    return profile.missing_counts(ev)


def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_cols(profile.value_counts(subscriber_view(spark, sf_dir), C.label_text), ["pct"])


def q_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir).select(C.tenure, C.monthly, C.total)
    return profile.describe(materialize(v, "subscribers"), [C.tenure, C.monthly, C.total])


def q_describe_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return profile.describe(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def q_class_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    cm = profile.class_means(subscriber_view(spark, sf_dir), C.label, list(C.numeric))
    return _round_cols(cm, [f"mean_{c}" for c in C.numeric])


def q_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.census(subscriber_view(spark, sf_dir))


def q_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = materialize(subscriber_view(spark, sf_dir), "subscribers")  # read by every section
    s = profile.summarize(v, C.label_text, [C.tenure, C.monthly, C.total])
    return _round_cols(s, ["value"])


# --- statistics -------------------------------------------------------------

CORR_COLUMNS = [C.tenure, C.monthly, C.total, C.senior, C.label]


def q_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_cols(stats.correlation(subscriber_view(spark, sf_dir), CORR_COLUMNS), ["r"])


def q_kde_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = stats.kde(subscriber_view(spark, sf_dir), C.tenure, C.label)
    return d.withColumns({"x": F.round("x", 9), "density": F.round("density", 9)})


def q_kde_binned_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The binned density of the charges against the exact one: points beyond the stated error."""
    v = materialize(subscriber_view(spark, sf_dir).select(C.monthly, C.label), "charges")
    exact = stats.kde(v, C.monthly, C.label)
    both = exact.join(stats.binned_kde(v, C.monthly, C.label).withColumnRenamed("density", "binned").drop("x"),
                      ["class", "point"])
    off = F.abs(F.col("binned") - F.col("density")) > F.col("error") + 1e-12 * F.col("density")
    return both.groupBy("class").agg(F.count(F.lit(1)).alias("n_points"), F.count_if(off).alias("n_off"),
                                     (F.max("error") < 0.01 * F.max("density")).alias("error_small"))


def q_describe_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of lineitem merged from those of its return flags; no row is sketched twice."""
    li = read_table(spark, sf_dir, "lineitem")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    parts = [column_summaries(li.where(F.col("l_returnflag").eqNullSafe(flag)), columns)
             for flag in [r[0] for r in li.select("l_returnflag").distinct().collect()]]  # three flags
    return profile.describe(li, columns, summaries=merge_summaries(*parts))


def q_report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rates by contract, written as a report table and read back."""
    return spark.read.parquet(write_report(q_contract_rates(spark, sf_dir), ensure_checkpoint_dir(spark),
                                           f"report-{uuid.uuid4().hex}"))


# --- encoding, scaling, split ----------------------------------------------

def q_one_hot_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    oh = encode.fit_one_hot(v, C.cluster_onehot, C.max_levels)
    return oh.transform(v).select(C.key, *oh.output_columns)


def q_one_hot_drop_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    spec = encode.fit_model_features(v, C)
    return spec.transform(v).select(C.key, *spec.names)


def q_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    cols = list(C.numeric)
    return _round_cols(encode.fit_standard_scaler(v, cols).transform(v).select(C.key, *cols), cols)


def orders_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))


def q_split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(orders_labelled(spark, sf_dir), "label", "o_orderkey", 0.2, 42) \
                .select("o_orderkey", "label", "is_test")


def q_split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = split.stratified_split(orders_labelled(spark, sf_dir), "label", "o_orderkey", 0.2, 42)
    return s.groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


def q_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assign_folds(orders_labelled(spark, sf_dir), "label", "o_orderkey", 5, 42) \
                .select("o_orderkey", "label", "fold")


def q_class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_cols(split.class_weights(orders_labelled(spark, sf_dir), "label"),
                       ["pos_weight", "w_pos", "w_neg"])


# --- metrics, segments, explanations on fixed-coefficient scores -----------
# Two fixed linear log-odds models over the standardised numeric columns stand
# in for fitted ones, so every downstream operator can be checked in SQL.
FIXED_A = {"intercept": -0.5, "tenure": -1.2, "monthly_charges": 0.4,
           "total_charges": -0.3, "senior": 0.2}
FIXED_B = {"intercept": -0.3, "tenure": -0.8, "monthly_charges": -0.2,
           "total_charges": -0.6, "senior": 0.1}


def _logit(coef: dict) -> F.Column:
    out = F.lit(coef["intercept"])
    for c in C.numeric:
        out = out + F.lit(coef[c]) * F.col(c)
    return out


def scored_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriber view + standardised numerics + both fixed scores and predictions.

    Stored once: everything derived from the scored rows reads this table.
    """
    v = subscriber_view(spark, sf_dir)
    z = encode.fit_standard_scaler(v, list(C.numeric)).transform(v)
    prob = lambda coef: F.round(1.0 / (1.0 + F.exp(-_logit(coef))), 9)
    scored = z.withColumns({"p_a": prob(FIXED_A), "p_b": prob(FIXED_B)}).withColumns(
        {"pred_a": (F.col("p_a") > 0.5).cast("int"), "pred_b": (F.col("p_b") > 0.5).cast("int")})
    return materialize(scored.select(C.key, C.label, C.contract, *C.numeric, "p_a", "p_b", "pred_a", "pred_b"), "scored")


FIXED_MODELS = {"a": ("pred_a", "p_a"), "b": ("pred_b", "p_b")}


def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(scored_fixed(spark, sf_dir), C.label, "pred_a")


def q_metrics_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sc = scored_fixed(spark, sf_dir)
    return _round_cols(metrics.threshold_metrics(sc, C.label, "pred_a"),
                       ["accuracy", "precision", "recall", "f1"])


def q_auc_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = metrics.metric_tables(scored_fixed(spark, sf_dir), C.label, FIXED_MODELS)
    return _round_cols(table.where("metric = 'auc'").select("model", F.col("value").alias("auc")), ["auc"])


def q_auc_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of the discount as a score for returned line items: heavy ties."""
    li = read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_discount")
    return _round_cols(metrics.roc_auc(li, "y", "l_discount"), ["auc"])


def q_roc_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_cols(metrics.roc_curve(scored_fixed(spark, sf_dir), C.label, "p_a"),
                       ["fpr", "tpr"])


def q_model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = metrics.metric_tables(scored_fixed(spark, sf_dir), C.label, FIXED_MODELS)
    return _round_cols(metrics.compare_models(table, "a", "b"), ["value_a", "value_b", "delta"])


def q_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.calibration_by(scored_fixed(spark, sf_dir), C.contract, C.label, "p_a")


def q_segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.profile_segments(subscriber_view(spark, sf_dir), C.contract, C.tenure,
                                    C.monthly, C.total, C.senior, C.label)


def q_segment_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    levels = list(encode.fit_one_hot(v, [("region", "region")], C.max_levels).specs[0][2])
    return segment.crosstab_pct(v, C.contract, "region", levels)


def q_personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.assign_personas(q_segment_profile(spark, sf_dir)) \
                  .select(C.contract, "n", "churn_rate", "persona", "action")


def q_segment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = subscriber_view(spark, sf_dir)
    return segment.canonical_ids(v, C.contract, C.label).select(C.key, C.contract, "segment_id")


def embeddings_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    e = read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label",
                    array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def q_silhouette_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = segment.squared_silhouette(embeddings_vectors(spark, sf_dir), "features", "label")
    return spark.range(1).select(F.round(F.lit(s), 6).alias("silhouette"))


LINEAR_FEATURES = list(C.numeric)


def linear_long(scored: DataFrame) -> DataFrame:
    coefs = [FIXED_A[c] for c in LINEAR_FEATURES]
    sc = scored.withColumn("shap", explain.linear_contributions(coefs, LINEAR_FEATURES))
    return explain.to_long(sc, C.key, LINEAR_FEATURES)


def shap_long_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linear_long(scored_fixed(spark, sf_dir))


def q_linear_shap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_cols(shap_long_fixed(spark, sf_dir), ["value", "shap"])


def q_shap_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_cols(explain.mean_abs_shap(shap_long_fixed(spark, sf_dir)), ["mean_abs_shap"])


def q_top_features_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most important features with what they stand for."""
    return explain.named_features(q_shap_importance(spark, sf_dir), VIEW_MEANINGS, 3)


def q_shap_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_cols(explain.contribution_cloud(shap_long_fixed(spark, sf_dir), 2),
                       ["value", "shap"])


def _top_long(df: DataFrame, extra=()) -> DataFrame:
    return (df.select(C.key, *extra, F.posexplode("top").alias("pos", "t"))
            .select(C.key, *extra, (F.col("pos") + 1).alias("rank"), "t.feature",
                    F.round("t.value", 6).alias("value"), F.round("t.shap", 6).alias("shap")))


def q_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    sc = scored_fixed(spark, sf_dir)
    coefs = [FIXED_A[c] for c in LINEAR_FEATURES]
    sc = sc.withColumn("shap", F.transform(explain.linear_contributions(coefs, LINEAR_FEATURES),
                                           lambda x: F.round(x, 9)))
    ex = explain.explain_customers(sc, C.key, "p_a", LINEAR_FEATURES, k=3, all_rows=True)
    return _top_long(ex)


def q_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.pick_examples(scored_fixed(spark, sf_dir), C.key, "p_a")


def q_explain_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    sc = scored_fixed(spark, sf_dir)
    coefs = [FIXED_A[c] for c in LINEAR_FEATURES]
    sc = sc.withColumn("shap", F.transform(explain.linear_contributions(coefs, LINEAR_FEATURES),
                                           lambda x: F.round(x, 9)))
    ex = explain.explain_customers(sc, C.key, "p_a", LINEAR_FEATURES, k=4)
    return _top_long(ex, ["kind"])


def feature_label_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed association of every model feature with churn (the T2/T3 input)."""
    v = subscriber_view(spark, sf_dir)
    spec = encode.fit_model_features(v, C)
    enc = spec.transform(v)
    corr = stats.correlation_with(enc, C.label, list(spec.names))
    return corr.select("feature", F.round("r", 9).alias("r"))


def q_top_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.top_abs(feature_label_corr(spark, sf_dir), "r", 10, tie="feature")


def q_top_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.top_signed(feature_label_corr(spark, sf_dir), "r", 5, tie="feature")


def q_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_cols(impact.estimate_impact(subscriber_view(spark, sf_dir), C, C.contract),
                       ["revenue"])


def q_executive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.operators import report
    v = materialize(subscriber_view(spark, sf_dir), "subscribers")  # read by every panel
    sc = scored_fixed(spark, sf_dir)
    return _round_cols(report.executive_summary(
        v, C, TENURE_EDGES_4, TENURE_LABELS_4, sc, FIXED_MODELS,
        shap_long=linear_long(sc), segment=C.contract), ["value"])


def q_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen order columns under friendly names."""
    names = {"o_orderkey": "order_id", "o_orderstatus": "status", "o_totalprice": "price"}
    return clean.rename(clean.select_columns(read_table(spark, sf_dir, "orders"), list(names)), names)


def q_flag_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of Yes per encoded flag; the flags are found by their suffix."""
    enc = encode.encode_flags(subscriber_view(spark, sf_dir), list(C.model_flags))
    flags = encode.columns_with_suffix(enc)
    return _round_cols(enc.agg(*[F.avg(c).alias(c) for c in flags]).unpivot([], flags, "flag", "share"), ["share"])


QUERIES = {
    "renamed": q_renamed,
    "flag_shares": q_flag_shares,
    "tenure_rates": q_tenure_rates,
    "tenure_rates_4bin": q_tenure_rates_4bin,
    "contract_rates": q_contract_rates,
    "multi_column_rates": q_multi_column_rates,
    "lineitem_rates": q_lineitem_rates,
    "overall_rate": q_overall_rate,
    "rate_summary": q_rate_summary,
    "coerce_drop": q_coerce_drop,
    "missing": q_missing,
    "value_counts": q_value_counts,
    "describe": q_describe,
    "describe_lineitem": q_describe_lineitem,
    "class_means": q_class_means,
    "census": q_census,
    "summary": q_summary,
    "corr_matrix": q_corr_matrix,
    "kde_by_class": q_kde_by_class,
    "kde_binned_check": q_kde_binned_check,
    "describe_merged": q_describe_merged,
    "report_round_trip": q_report_round_trip,
    "one_hot_all": q_one_hot_all,
    "one_hot_drop_first": q_one_hot_drop_first,
    "standardized": q_standardized,
    "split_exact": q_split_exact,
    "split_sizes": q_split_sizes,
    "folds": q_folds,
    "class_weights": q_class_weights,
    "confusion": q_confusion,
    "metrics_fixed": q_metrics_fixed,
    "auc_fixed": q_auc_fixed,
    "auc_lineitem": q_auc_lineitem,
    "roc_fixed": q_roc_fixed,
    "model_compare": q_model_compare,
    "calibration": q_calibration,
    "segment_profile": q_segment_profile,
    "segment_crosstab": q_segment_crosstab,
    "personas": q_personas,
    "segment_ids": q_segment_ids,
    "silhouette_fixed": q_silhouette_fixed,
    "linear_shap": q_linear_shap,
    "shap_importance": q_shap_importance,
    "top_features_named": q_top_features_named,
    "shap_cloud": q_shap_cloud,
    "top_features": q_top_features,
    "examples": q_examples,
    "explain_examples": q_explain_examples,
    "top_abs": q_top_abs,
    "top_signed": q_top_signed,
    "impact": q_impact,
    "executive_summary": q_executive_summary,
}


# --- models, segmentation: results of fits have no SQL twin; the *_check and
# gradient queries state invariants whose twin is computed from the tables -----
# Fitted models are kept per (application, input, kind) so the queries built on
# one fit (scores, comparison, explanations) do not refit it; ``release`` drops them.
_FITS: dict = {}


def _cached(spark: SparkSession, sf_dir: str, kind: str, make):
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _FITS:
        _FITS[key] = make()
    return _FITS[key]


def release(sf_dir: str | None = None) -> None:
    """Forget the fits of one input folder, or of all."""
    for key in [k for k in _FITS if sf_dir in (None, k[1])]:
        del _FITS[key]


def _run(spark: SparkSession, sf_dir: str):
    from churnlens.plans import flows
    return _cached(spark, sf_dir, "run", lambda: flows.prepare(subscriber_view(spark, sf_dir), C))


def _logistic(spark: SparkSession, sf_dir: str):
    from churnlens.plans import flows
    return _cached(spark, sf_dir, "logistic", lambda: flows.logistic_models(_run(spark, sf_dir), C))


def _cv(spark: SparkSession, sf_dir: str):
    from churnlens.plans import flows
    return _cached(spark, sf_dir, "cv", lambda: flows.cross_validate(_run(spark, sf_dir), C, GBTConfig()))


def _gbt(spark: SparkSession, sf_dir: str):
    return _cv(spark, sf_dir).trees


def _segmentation(spark: SparkSession, sf_dir: str):
    from churnlens.plans import flows
    return _cached(spark, sf_dir, "segmentation",
                   lambda: flows.segmentation(subscriber_view(spark, sf_dir), C))


def q_kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inertia and Euclidean silhouette for k = 2..8 on the embeddings."""
    return segment.sweep_k(embeddings_vectors(spark, sf_dir))[0]


def q_kmeans_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best of several k-means starts: centres are their rows' means, the inertia is the rows' (M2)."""
    from pyspark.ml.functions import vector_to_array

    vectors = embeddings_vectors(spark, sf_dir)
    fit = segment.fit_segments(vectors, k=4, n_init=4)
    centers = spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(fit.centers)],
                                    "cluster int, center array<double>")
    rows = fit.assign(vectors).join(F.broadcast(centers), "cluster").withColumn("x", vector_to_array("features"))
    apart = F.aggregate(F.zip_with("x", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, d: a + d)
    away = rows.select("cluster", F.posexplode(F.zip_with("x", "center", lambda a, b: a - b)).alias("i", "d")) \
        .groupBy("cluster", "i").agg(F.avg("d").alias("d")).agg(F.count_if(F.abs("d") > 0.01).alias("n_off_mean"))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cluster").alias("n_clusters"),
                    (F.abs(F.sum(apart) / F.lit(fit.inertia) - 1) < 1e-9).alias("inertia_holds")).select(
        "*", away.select("n_off_mean").scalar().alias("n_off_mean"))


def q_silhouette_euclid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Euclidean silhouette of the embeddings' labels against 32 references per label (M4)."""
    got = euclidean_silhouette(read_table(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding", 32)
    return got.select("n", "n_references", F.round("silhouette", 6).alias("silhouette"))


def _scaled_embeddings(spark: SparkSession, sf_dir: str):
    """Embeddings with every dimension scaled by its population deviation."""
    from pyspark.ml.feature import VectorAssembler

    e = read_table(spark, sf_dir, "embeddings")
    names = [f"e{i}" for i in range(e.select(F.max(F.size("embedding"))).first()[0])]
    wide = e.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)])
    z = encode.fit_standard_scaler(wide, names).transform(wide)
    return VectorAssembler(inputCols=names, outputCol="z").transform(z).select("vec_id", "label", "z"), names


def q_pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    z, _ = _scaled_embeddings(spark, sf_dir)
    pts, ratios = segment.project_2d(z, "z", key="vec_id", extra=["label"])
    return pts.withColumns({"ev1": F.lit(ratios[0]), "ev2": F.lit(ratios[1])})


def q_pca_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components are centred, uncorrelated, and hold the stated share of the variance (M5)."""
    z, names = _scaled_embeddings(spark, sf_dir)
    pts, ratios = segment.project_2d(z, "z", key="vec_id")
    off = lambda c: F.round(F.abs(c), 6)
    total = float(len(names))  # every scaled dimension has variance one
    return pts.agg(F.count(F.lit(1)).alias("n_rows"), off(F.avg("pc1")).alias("mean_1"), off(F.avg("pc2")).alias("mean_2"),
                   off(F.covar_pop("pc1", "pc2")).alias("covariance"),
                   off(F.var_pop("pc1") / total - ratios[0]).alias("share_1_off"),
                   off(F.var_pop("pc2") / total - ratios[1]).alias("share_2_off"))


def q_segments_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer has a segment, ids follow the churn rate, the best k is the sweep's."""
    s = _segmentation(spark, sf_dir)
    rows = s.segmented.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("segment_id").isNull()).alias("n_without"),
                           F.count_distinct("segment_id").alias("k_used"))
    rate = s.segmented.groupBy("segment_id").agg(F.avg(C.label).alias("r"))
    a, b = rate.alias("a"), rate.alias("b")
    bad = a.join(b, F.col("b.segment_id") == F.col("a.segment_id") + 1).where("b.r > a.r").agg(
        F.count(F.lit(1)).alias("n_out_of_order"))
    best = s.sweep.agg(F.count_if("best").alias("n_best"), F.max(F.when(F.col("best"), F.col("k"))).alias("k"),
                       F.count(F.lit(1)).alias("n_k"))
    one = lambda d, c: d.select(c).scalar()
    return rows.select("n_rows", "n_without", one(bad, "n_out_of_order").alias("n_out_of_order"),
                       one(best, "n_best").alias("n_best"), one(best, "n_k").alias("n_k"),
                       (F.col("k_used") - one(best, "k")).alias("k_off"))


def q_segment_risk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment risk covers every customer once, with rates in range."""
    r = q_segment_risk(spark, sf_dir)
    ok = F.col("actual_rate").between(0, 1) & F.col("predicted_prob").between(0, 1)
    return r.agg(F.sum("n").alias("n_rows"), F.count_if(~ok).alias("n_out_of_range"))


def q_attached_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment and score attached by key: rows, those unlike the segment's own scoring, a key given twice refused."""
    _, b = _logistic(spark, sf_dir)
    view, segmented = subscriber_view(spark, sf_dir), _segmentation(spark, sf_dir).segmented
    segments = segmented.select(C.key, "segment_id")
    scores = materialize(b.score(view).select(C.key, "prob"), "scores-by-key")
    both = joins.attach_by_key(joins.attach_by_key(view.select(C.key), segments, C.key), scores, C.key)
    own = b.score(segmented).select(C.key, F.col("segment_id").alias("own_segment"), F.col("prob").alias("own_prob"))
    off = ~(F.col("segment_id").eqNullSafe(F.col("own_segment")) & (F.abs(F.col("prob") - F.col("own_prob")) < 1e-12))
    try:
        joins.attach_by_key(view, segments.union(segments.limit(1)), C.key)
        refused = False
    except ValueError:
        refused = True
    return both.join(own, C.key, "left").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(off, F.lit(True))).alias(
        "n_off")).withColumn("duplicate_refused", F.lit(refused))


def q_logistic_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objective's gradient at both fitted models, which must vanish."""
    from churnlens.operators import models
    from churnlens.schema import LogisticConfig

    run = _run(spark, sf_dir)
    weighted = split.with_weights(run.train, C.label, "balanced")
    out = None
    for name, m, c in zip(("baseline", "ridge"), _logistic(spark, sf_dir), (1e9, LogisticConfig().c)):
        z = m.pipeline.stages[0].transform(weighted)
        beta = [float(x) for x in m.estimator.coefficients.toArray()]
        cols = [F.col(f"`{n}{models.Z}`") for n in m.names]
        eta = F.lit(float(m.estimator.intercept))
        for b, x in zip(beta, cols):
            eta = eta + F.lit(b) * x
        z = z.withColumn("_r", F.col("weight") * (1.0 / (1.0 + F.exp(-eta)) - F.col(C.label)))
        sums = z.agg(F.sum("weight").alias("w"), F.sum("_r").alias("g_0"),
                     *[F.sum(F.col("_r") * x).alias(f"g_{i + 1}") for i, x in enumerate(cols)])
        rows = [F.struct(F.lit(name).alias("model"), F.lit(n).alias("feature"), F.round(F.abs(
            F.col(f"g_{i}") / F.col("w") + (F.lit(b) / F.col("w") / F.lit(c))), 3).alias("gradient"))
            for i, (n, b) in enumerate(zip(("(intercept)", *m.names), (0.0, *beta)))]
        part = sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out


def q_test_scores_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model and class: scored test rows, and those with an impossible score."""
    from churnlens.plans import flows

    a, b = _logistic(spark, sf_dir)
    parts = None
    for name, m in (("baseline", a), ("ridge", b), ("gbt", _gbt(spark, sf_dir))):
        s = flows.scored_test(m, _run(spark, sf_dir), C)
        bad = F.coalesce(~F.col("prob").between(0, 1) | (F.col("prediction") != (F.col("prob") > 0.5).cast("int")), F.lit(True))
        s = s.groupBy(C.label).agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_bad")).withColumn("model", F.lit(name))
        parts = s if parts is None else parts.unionByName(s)
    return parts.select("model", C.label, "n", "n_bad")


def q_shap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tree contributions and base add up to the logit on every test row."""
    from churnlens.operators import models
    from churnlens.plans import flows

    m, run = _gbt(spark, sf_dir), _run(spark, sf_dir)
    trees = models.gbt_trees(m, ensure_checkpoint_dir(spark))
    base = m.margin_scale * sum(t.weight * t.expected_value() for t in trees)
    total = q_gbt_shap(spark, sf_dir).groupBy(C.key).agg(F.sum("shap").alias("s"), F.count(F.lit(1)).alias("f"))
    scored = flows.scored_test(m, run, C)
    logit = F.log(F.col("prob") / (1 - F.col("prob")))
    return joins.merged(scored, total, C.key, "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.coalesce(F.abs(F.col("s") + base - logit) > 1e-6, F.lit(True))).alias("n_off"),
        F.min("f").alias("f_min"), F.max("f").alias("f_max"))


def q_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segmentation(spark, sf_dir).personas


def q_segment_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segmentation(spark, sf_dir).sweep


def q_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.plans import flows
    _, b = _logistic(spark, sf_dir)
    return flows.scored_test(b, _run(spark, sf_dir), C)


def q_logistic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.plans import flows
    a, b = _logistic(spark, sf_dir)
    scored = flows.scored_by(_run(spark, sf_dir), C, baseline=a, ridge=b)
    return metrics.metric_tables(scored, C.label, flows.model_columns("baseline", "ridge"))


def q_confusion_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(q_logistic(spark, sf_dir), C.label, "prediction")


def q_roc_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC curves of both logistic models and the trees."""
    from churnlens.plans import flows
    a, b = _logistic(spark, sf_dir)
    scored = flows.scored_by(_run(spark, sf_dir), C, baseline=a, ridge=b, gbt=_gbt(spark, sf_dir))
    return metrics.roc_curves(scored, C.label, flows.model_columns("baseline", "ridge", "gbt"))


def q_roc_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_curve(q_logistic(spark, sf_dir), C.label, "prob")


def q_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.plans import flows
    _, b = _logistic(spark, sf_dir)
    return flows.coefficient_table(b)


def q_coefficient_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five strongest churn-raising and five strongest churn-lowering features."""
    return explain.top_signed(q_coefficients(spark, sf_dir), "coefficient", 5, tie="feature")


def q_cv_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of both logistic models and the trees on every fold."""
    return _cv(spark, sf_dir).folds


def q_cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and population deviation of the fold AUCs per model."""
    from churnlens.operators import models

    return models.cv_summary(_cv(spark, sf_dir).folds)


def _chance_variance(pos, neg) -> F.Column:
    """Variance of the area under the curve of a score that knows nothing of the label."""
    return (pos + neg + 1) / (12.0 * pos * neg)


def _rank_auc(scores: DataFrame, by: list[str]) -> DataFrame:
    """(*by, n, pos, auc) by mean ranks of the positives, another way than ``metrics``."""
    w = Window.partitionBy(*by).orderBy("score")
    ties = Window.partitionBy(*by, "score")
    ranked = scores.withColumn("rank", F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0)
    pos = F.sum("label")
    neg = F.count(F.lit(1)) - pos
    return ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), pos.alias("pos"), neg.alias("neg"), (
        (F.sum(F.when(F.col("label") == 1, F.col("rank"))) - pos * (pos + 1) / 2.0) / (pos * neg)).alias("by_rank"))


def q_cv_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model and fold: rows scored, the AUC against one from mean ranks, and whether the model beats chance.

    It does if its mean AUC is more than two standard errors of a score
    without information above one half.
    """
    cv = _cv(spark, sf_dir)
    both = _rank_auc(cv.scores, ["model", "fold"]).join(cv.folds, ["model", "fold"])
    w = Window.partitionBy("model")  # one row per fold
    error = F.sqrt(F.sum(_chance_variance(F.col("pos"), F.col("neg"))).over(w)) / F.count(F.lit(1)).over(w)
    return both.select("model", "fold", "n", (F.abs(F.col("auc") - F.col("by_rank")) < 1e-9).alias("auc_holds"),
                       (F.avg("auc").over(w) - 0.5 > 2.0 * error).alias("beyond_chance"))


def q_test_auc_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model: test rows, and whether its AUC there beats chance."""
    from churnlens.plans import flows

    a, b = _logistic(spark, sf_dir)
    scored = flows.scored_by(_run(spark, sf_dir), C, baseline=a, ridge=b, gbt=_gbt(spark, sf_dir))
    names = ("baseline", "ridge", "gbt")
    long = scored.select(F.col(C.label).alias("label"), F.explode(F.array(*[F.struct(
        F.lit(n).alias("model"), F.col(f"prob_{n}").alias("score")) for n in names])).alias("s")).select("label", "s.*")
    error = F.sqrt(_chance_variance(F.col("pos"), F.col("neg")))
    return _rank_auc(long, ["model"]).select("model", "n", (F.col("by_rank") - 0.5 > 2.0 * error).alias("beyond_chance"))


def q_segment_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.plans import flows
    _, b = _logistic(spark, sf_dir)
    return flows.segment_risk(b, _segmentation(spark, sf_dir).segmented, C)


def q_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.plans import flows
    return flows.scored_test(_gbt(spark, sf_dir), _run(spark, sf_dir), C)


def q_gbt_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.plans import flows
    _, b = _logistic(spark, sf_dir)
    return flows.compare(b, _gbt(spark, sf_dir), _run(spark, sf_dir), C)


def q_gbt_shap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.plans import flows
    return _cached(spark, sf_dir, "contributions",
                   lambda: flows.gbt_explanations(_gbt(spark, sf_dir), _run(spark, sf_dir), C))


def q_gbt_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.mean_abs_shap(q_gbt_shap(spark, sf_dir))


def q_gbt_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain.contribution_cloud(q_gbt_shap(spark, sf_dir), 15)


def q_gbt_explain(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.plans import flows
    ex = flows.explain_examples(_gbt(spark, sf_dir), _run(spark, sf_dir), C, 12)
    return (ex.select(C.key, "kind", "prob", F.posexplode("top").alias("pos", "t"))
            .select(C.key, "kind", "prob", (F.col("pos") + 1).alias("rank"), "t.feature", "t.value",
                    "t.shap"))


# --- sources and stored steps -------------------------------------------------

CSV_COLUMNS = (C.key, C.contract, C.senior, C.tenure, C.monthly, C.total, C.label_text)


def q_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view written as CSV with damaged lines and read back: good rows, and faults by column and reason.

    Keys divisible by 7 get a word for their tenure, those divisible by 11 a
    unit behind their charges, those divisible by 13 a field too many.
    """
    from pyspark.sql import types as T

    v = subscriber_view(spark, sf_dir).select(*CSV_COLUMNS)
    key = F.col(C.key)
    text = [F.col(c).cast("string").alias(c) for c in CSV_COLUMNS]
    damaged = v.select(*text).withColumns({
        C.tenure: F.when(key % 7 == 0, F.lit("long")).otherwise(F.col(C.tenure)),
        C.monthly: F.when(key % 11 == 0, F.concat(C.monthly, F.lit(" EUR"))).otherwise(F.col(C.monthly))})
    line = F.concat(F.to_csv(F.struct(*CSV_COLUMNS)), F.when(key % 13 == 0, F.lit(",more")).otherwise(F.lit("")))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/subscribers-csv-{uuid.uuid4().hex}"
    damaged.select(line.alias("line")).write.text(path)
    schema = T.StructType([T.StructField(C.key, T.LongType()), T.StructField(C.contract, T.StringType()),
                           T.StructField(C.senior, T.IntegerType()), T.StructField(C.tenure, T.DoubleType()),
                           T.StructField(C.monthly, T.DoubleType()), T.StructField(C.total, T.DoubleType()),
                           T.StructField(C.label_text, T.StringType())])
    good, rejects = read_with_rejects(spark, path, schema, header=False)
    rows = good.agg(F.lit("good").alias("kind"), F.lit(None).cast("string").alias("column"), F.count(F.lit(1)).alias("n"),
                    F.round(F.sum(C.monthly), 2).alias("monthly"), F.sum(C.key).alias("keys"))
    faults = rejects.groupBy(F.col("reason").alias("kind"), "column").agg(
        F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("monthly"), F.lit(None).cast("long").alias("keys"))
    return rows.unionByName(faults)


def q_resumed_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps stored and resumed: rows scored, rows whose score or segment differs, tables skipped."""
    import warnings

    from churnlens.plans import flows
    from churnlens.sources.steps import fingerprint

    run, (_, b), seg = _run(spark, sf_dir), _logistic(spark, sf_dir), _segmentation(spark, sf_dir)
    source = fingerprint(subscriber_view(spark, sf_dir))
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/steps-{uuid.uuid4().hex}"
    flows.store_models(run, {"logistic": b, "gbt": _gbt(spark, sf_dir)}, root, source)
    flows.store_segmentation(seg, root, source)
    data, fitted = flows.resume_models(spark, root, source)
    test = data.where("is_test = 1")
    again = fitted["logistic"].score(fitted["gbt"].score(test, "gbt", "pred_gbt"), "logistic", "pred_logistic")
    first = flows.scored_by(run, C, logistic=b, gbt=_gbt(spark, sf_dir))
    differ = F.coalesce((F.abs(F.col("gbt") - F.col("prob_gbt")) > 1e-12)
                        | (F.abs(F.col("logistic") - F.col("prob_logistic")) > 1e-12), F.lit(True))
    both = joins.merged(again.select(C.key, "gbt", "logistic"), first, C.key, "left").agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(differ).alias("n_scores_off"))
    old = seg.segmented.select(C.key, F.col("segment_id").alias("old"))
    named = joins.merged(flows.resume_segmented(spark, root, C, source).select(C.key, "segment_id"), old, C.key, "left").agg(
        F.count(F.lit(1)).alias("n_segmented"), F.count_if(~F.col("segment_id").eqNullSafe(F.col("old"))).alias("n_segments_off"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        skipped = [flows.resumed_risk(spark, f"{root}-none", C), flows.resumed_comparison(spark, f"{root}-none", C),
                   flows.resumed_risk(spark, root, C, source="another input")]
    done = [flows.resumed_risk(spark, root, C, source=source), flows.resumed_comparison(spark, root, C, source)]
    return both.crossJoin(named).withColumns({  # one row each
        "n_skipped": F.lit(sum(t is None for t in skipped)).cast("long"),
        "n_resumed": F.lit(sum(t.count() > 0 for t in done)).cast("long")})


MODEL_QUERIES = {
    "csv_rejects": q_csv_rejects,
    "resumed_check": q_resumed_check,
    "kmeans_sweep": q_kmeans_sweep,
    "kmeans_check": q_kmeans_check,
    "silhouette_euclid": q_silhouette_euclid,
    "pca_check": q_pca_check,
    "segments_check": q_segments_check,
    "segment_risk_check": q_segment_risk_check,
    "attached_check": q_attached_check,
    "logistic_gradient": q_logistic_gradient,
    "test_scores_check": q_test_scores_check,
    "shap_check": q_shap_check,
    "cv_check": q_cv_check,
    "test_auc_check": q_test_auc_check,
    "cv_summary": q_cv_summary,
    "roc_models": q_roc_models,
    "pca_2d": q_pca_2d,
    "segments": q_segments,
    "segment_sweep": q_segment_sweep,
    "logistic": q_logistic,
    "logistic_metrics": q_logistic_metrics,
    "confusion_logistic": q_confusion_logistic,
    "roc_logistic": q_roc_logistic,
    "coefficients": q_coefficients,
    "coefficient_signs": q_coefficient_signs,
    "cv_auc": q_cv_auc,
    "segment_risk": q_segment_risk,
    "gbt": q_gbt,
    "gbt_compare": q_gbt_compare,
    "gbt_shap": q_gbt_shap,
    "gbt_importance": q_gbt_importance,
    "gbt_cloud": q_gbt_cloud,
    "gbt_explain": q_gbt_explain,
}
QUERIES.update(MODEL_QUERIES)
