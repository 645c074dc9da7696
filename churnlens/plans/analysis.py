"""The whole subscriber analysis as one Spark job chain.

Load and clean (S1, P1-P3) -> profiles and rates (R1, A5, A6, R2, A8, A9)
-> segmentation (E1) -> logistic models (E2) -> boosted trees and
explanations (E3) -> impact (A14) -> executive summary (R3).  Every result
table is written with ``write_report`` (S5), the segmented table with
``write_segmented`` (S3) and both models with the model store (S4), under
``out_dir`` (a shared folder on a cluster).

The default column preset is the subscriber file's; pass another
``SubscriberColumns`` for other column names.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators import explain, impact, metrics, models, profile, rates, report, segment, stats
from churnlens.plans import flows
from churnlens.schema import (FEATURE_MEANINGS, SUBSCRIBER, TENURE_EDGES_4, TENURE_EDGES_6, TENURE_LABELS_4,
                              TENURE_LABELS_6, GBTConfig, ImpactConfig, SegmentConfig,
                              SubscriberColumns)
from churnlens.session import materialize
from churnlens.sources.model_store import save_model
from churnlens.sources.steps import fingerprint
from churnlens.sources.subscribers import load_subscribers, write_report, write_segmented


def analyse_subscribers(spark: SparkSession, path: str, out_dir: str, fmt: str = "csv",
                        cols: SubscriberColumns = SUBSCRIBER,
                        segment_cfg: SegmentConfig = SegmentConfig(),
                        gbt_cfg: GBTConfig = GBTConfig(),
                        impact_cfg: ImpactConfig = ImpactConfig()) -> dict[str, str]:
    """Run every step and return ``{table name: path}``."""
    df, obs = load_subscribers(spark, path, fmt, cols)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    numeric = [cols.tenure, cols.monthly, cols.total]
    out: dict[str, str] = {}

    def save(name: str, table: DataFrame) -> None:
        out[name] = write_report(table, out_dir, name)

    # the first action fills the load observation (rows read / dropped)
    save("summary", profile.summarize(df, cols.label_text, numeric))
    load = obs.get
    save("load_counts", spark.createDataFrame(
        [(int(load["rows_in"]), int(load["rows_dropped"]))], "rows_in long, rows_dropped long"))
    save("rates_by_category", rates.rate_by(df, list(cols.rate_columns), cols.label))
    save("tenure_rates", rates.rate_by_bin(df, cols.tenure, TENURE_EDGES_6, TENURE_LABELS_6,
                                           cols.label))
    save("rate_summary", rates.rate_summary(df, cols.tenure, TENURE_EDGES_4, TENURE_LABELS_4,
                                            cols.label, [cols.contract, *cols.cluster_flags[:1]]))
    save("class_means", profile.class_means(df, cols.label, list(cols.numeric)))
    save("correlation", stats.correlation(df, [*numeric, cols.senior, cols.label]))
    dens = None
    for c in numeric:
        d = stats.kde(df, c, cols.label_text).withColumn("variable", F.lit(c))
        dens = d if dens is None else dens.unionByName(d)
    save("density", dens)

    # E1 segmentation
    seg = flows.segmentation(df, cols, segment_cfg)
    segmented = seg.segmented
    write_segmented(segmented, f"{out_dir.rstrip('/')}/segmented")
    out["segmented"] = f"{out_dir.rstrip('/')}/segmented"
    save("k_sweep", seg.sweep)
    save("segment_profile", seg.profile)
    save("personas", seg.personas)
    save("segment_contract_mix", segment.crosstab(segmented, "segment_id", cols.contract))
    save("segment_points", seg.points)
    save("segment_point_shares", seg.shares)
    flows.save_segments(seg, f"{out_dir.rstrip('/')}/models/segments")
    source = fingerprint(df)
    steps_dir = f"{out_dir.rstrip('/')}/steps"
    flows.store_segmentation(seg, steps_dir, source)

    # E2 logistic models
    run = flows.prepare(df, cols)
    base, ridge = flows.logistic_models(run, cols)
    scored_b = flows.scored_test(ridge, run, cols)
    scored_ab = flows.scored_by(run, cols, baseline=base, ridge=ridge)
    save("logistic_metrics", metrics.metric_tables(scored_ab, cols.label, flows.model_columns("baseline", "ridge")))
    save("confusion", metrics.confusion_matrix(scored_b, cols.label, "prediction"))
    save("coefficients", flows.coefficient_table(ridge))
    cv = flows.cross_validate(run, cols, gbt_cfg)
    save("cv_auc", cv.folds)
    save("cv_summary", models.cv_summary(cv.folds))
    save("segment_risk", flows.segment_risk(ridge, segmented, cols))
    save_model(ridge, f"{out_dir.rstrip('/')}/models/logistic")

    # E3 boosted trees and explanations
    trees = cv.trees
    save_model(trees, f"{out_dir.rstrip('/')}/models/gbt")
    flows.store_models(run, {"logistic": ridge, "gbt": trees}, steps_dir, source)
    save("model_comparison", flows.compare(ridge, trees, run, cols))
    scored_all = materialize(flows.scored_by(run, cols, baseline=base, ridge=ridge, gbt=trees), "scored")
    save("roc", metrics.roc_curves(scored_all, cols.label, flows.model_columns("baseline", "ridge", "gbt")))
    shap_long = flows.gbt_explanations(trees, run, cols)
    save("shap_importance", explain.mean_abs_shap(shap_long))
    save("shap_top_features", explain.named_features(explain.mean_abs_shap(shap_long), FEATURE_MEANINGS))
    save("shap_cloud", explain.contribution_cloud(shap_long, 15))
    ex = flows.explain_examples(trees, run, cols, 12)
    save("shap_examples", ex.select(cols.key, "kind", "prob", F.posexplode("top").alias("pos", "t"))
         .select(cols.key, "kind", "prob", (F.col("pos") + 1).alias("rank"), "t.*"))

    # impact and executive summary on the segmented table
    save("impact", impact.estimate_impact(segmented, cols, "segment_id", impact_cfg))
    columns = flows.model_columns("ridge", "gbt")
    save("executive_summary", report.executive_summary(
        segmented, cols, TENURE_EDGES_4, TENURE_LABELS_4, scored_all,
        {"logistic": columns["ridge"], "gbt": columns["gbt"]},
        shap_long=shap_long, segment="segment_id"))
    df.unpersist()
    return out
