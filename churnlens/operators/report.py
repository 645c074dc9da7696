"""Executive summary as one long table.

Six panels, all computed (the reference typed the model, SHAP and segment
numbers in by hand): churn share, churn by tenure bin, churn by contract,
model scores, top contributions, riskiest segments.
Output ``(panel, item, value)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions import round_half_even
from churnlens.operators import explain, metrics, profile, rates, segment as seg_ops
from churnlens.schema import SubscriberColumns


def executive_summary(df: DataFrame, cols: SubscriberColumns, edges: Sequence[float],
                      labels: Sequence[str], scored: DataFrame, models: Mapping[str, tuple[str, str]],
                      shap_long: DataFrame, segment: str, top_shap: int = 7,
                      top_segments: int = 5) -> DataFrame:
    """``models`` maps each model to its (prediction, score) columns of ``scored``."""
    def panel(name, d, item, value):
        return d.select(F.lit(name).alias("panel"), F.col(item).cast("string").alias("item"),
                        F.col(value).cast("double").alias("value"))

    parts = [
        panel("churn_share", profile.value_counts(df, cols.label_text)
              .withColumn("pct", round_half_even("pct", 1)), "value", "pct"),
        panel("tenure", rates.rate_by_bin(df, cols.tenure, edges, labels, cols.label),
              "bin_label", "churn_rate"),
        panel("contract", rates.rate_by(df, cols.contract, cols.label), "level", "churn_rate"),
    ]
    m = (metrics.metric_tables(scored, cols.label, models).where(F.col("metric").isin("auc", "f1"))
         .withColumn("item", F.concat_ws(":", "model", "metric")))
    parts.append(panel("model", m, "item", "value"))
    parts.append(panel("shap", explain.top_features(explain.mean_abs_shap(shap_long), top_shap),
                       "feature", "mean_abs_shap"))
    prof = seg_ops.profile_segments(df, segment, cols.tenure, cols.monthly, cols.total,
                                    cols.senior, cols.label)
    risky = prof.orderBy(F.desc("churn_rate"), F.desc("n"), segment).limit(top_segments)
    parts.append(panel("segment", risky, segment, "churn_rate"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
