"""Classifier metrics on scored rows.

Input rows carry a 0/1 ``label``, a 0/1 ``prediction`` and a ``score``
(probability of class 1).  One pass collapses them to distinct (model, score,
prediction) with class counts, stored once; cells, AUC and ROC come from these
groups.  AUC and ROC take running sums slice-wise (``ranking.running_sums``),
so no task holds all scores even when most rows share one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions import round_half_even, safe_ratio
from churnlens.operators.ranking import running_sums
from churnlens.schema import AUC_MARGIN
from churnlens.session import materialize

METRIC_ORDER = ["accuracy", "precision", "recall", "f1", "auc"]


def confusion_cells(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, tn, fn."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """2x2 ``(actual, predicted, n)`` with empty cells as 0."""
    cells = confusion_cells(df, label, prediction)
    return cells.select(F.explode(F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("n")),
    )).alias("c")).select("c.*")


def _ratios(cells: DataFrame, *keep: str) -> DataFrame:
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return cells.select(
        *keep, safe_ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"), safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(tp * 2, tp * 2 + fp + fn).alias("f1"))


def threshold_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall, F1 of class 1 in one row.

    A ratio with an empty denominator is 0, as scikit-learn reports it.
    """
    return _ratios(confusion_cells(df, label, prediction))


def score_groups(df: DataFrame, label: str, models: Mapping[str, tuple[str | None, str]],
                 decimals: int | None = None) -> DataFrame:
    """Rows collapsed to ``(model, score, prediction, pos, neg)``, stored.

    ``models`` maps a name to its (prediction, score) columns of ``df``.  One
    pass over the scored rows serves all models and everything derived below,
    which reads the stored groups.  Null and NaN scores become null here:
    they count in the threshold metrics and are left out of AUC and ROC.
    """
    def score(c):
        x = F.col(c).cast("double")
        x = x if decimals is None else F.round(x, decimals)
        return F.when(~F.isnan(x), x)

    each = F.explode(F.array(*[F.struct(
        F.lit(name).alias("model"), score(s).alias("score"),
        (F.col(p).cast("int") if p else F.lit(None).cast("int")).alias("prediction"))
        for name, (p, s) in models.items()])).alias("m")
    return materialize(
        df.select((F.col(label) == 1).alias("y"), each).groupBy("m.model", "m.score", "m.prediction")
        .agg(F.count_if("y").alias("pos"), F.count_if(~F.coalesce("y", F.lit(False))).alias("neg")), "scores")


def _by_score(groups: DataFrame) -> DataFrame:
    return (groups.where(F.col("score").isNotNull()).groupBy("model", "score")
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def _auc(groups: DataFrame) -> DataFrame:
    """``(model, auc)`` over distinct scores."""
    return group_auc(_by_score(groups), ["model"])


def group_auc(groups: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, auc)`` in Mann-Whitney form from stored ``(*by, score, pos, neg)``, one row per distinct score."""
    g = running_sums(groups, "score", ["neg"], by)
    part = F.col("pos") * (F.col("neg_cum") - F.col("neg")) + F.col("pos") * F.col("neg") * 0.5
    return g.groupBy(*by).agg(F.try_divide(F.sum(part.cast("double")),
                                               (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, ties counted half (M16). One row ``auc``.

    ``sum(pos_s * (neg below s) + pos_s * neg_s / 2) / (P * N)`` over the
    distinct scores s.  Rows with a null or NaN score are left out, as in the
    curve; without a row of either class the area is null.
    """
    auc = _auc(score_groups(df, label, {"": (None, score)}))
    return auc.agg(F.max("auc").alias("auc"))


def roc_curves(df: DataFrame, label: str, models: Mapping[str, tuple[str | None, str]],
               score_decimals: int | None = None) -> DataFrame:
    """``(model, threshold, fpr, tpr)`` at every distinct score, highest first.

    Includes the start point (threshold +inf, 0, 0).  All thresholds are kept
    (no dropping of collinear points).  Rows with a null or NaN score are left
    out, of the totals too.  ``score_decimals`` rounds scores first, which
    bounds a curve of probabilities to 10^d + 1 points: the points that remain
    lie on the exact curve, those between are skipped, so a rate read at a
    threshold is that of a threshold at most 0.5 * 10^-d away.
    """
    g = _by_score(score_groups(df, label, models, score_decimals))
    totals = g.groupBy("model").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))  # one row per model
    cum = running_sums(g, "score", ["pos", "neg"], ["model"], descending=True).join(F.broadcast(totals), "model")
    pts = cum.select("model", F.col("score").alias("threshold"),
                     safe_ratio(F.col("neg_cum"), F.col("N"), None).alias("fpr"),
                     safe_ratio(F.col("pos_cum"), F.col("P"), None).alias("tpr"))
    start = df.sparkSession.createDataFrame([(m, float("inf"), 0.0, 0.0) for m in models],
                                            "model string, threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              score_decimals: int | None = None) -> DataFrame:
    """``(threshold, fpr, tpr)`` of one score; see ``roc_curves``."""
    return roc_curves(df, label, {"": (None, score)}, score_decimals).drop("model")


def metric_tables(df: DataFrame, label: str, models: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Long ``(model, metric, value)``: threshold metrics and AUC of several models in one pass."""
    groups = score_groups(df, label, models)
    hit = F.col("prediction") == 1
    cells = groups.groupBy("model").agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("tn"), F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"))
    wide = _ratios(cells, "model").join(_auc(groups), "model", "left")
    return wide.unpivot(["model"], METRIC_ORDER, "metric", "value")


def metric_table(df: DataFrame, model: str, label: str = "label", prediction: str = "prediction",
                 score: str = "score") -> DataFrame:
    """Long ``(model, metric, value)`` with the four threshold metrics and AUC."""
    return metric_tables(df, label, {model: (prediction, score)})


def compare_models(table: DataFrame, a: str, b: str, margin: float = AUC_MARGIN) -> DataFrame:
    """Side-by-side metrics of two models, difference, and the keep decision.

    ``table`` is a ``metric_tables`` output; ``a`` is the interpretable
    (linear) model.  The decision row keeps ``a`` unless ``b`` differs in AUC by
    at least ``margin``.
    """
    def of(m):
        return F.max(F.when(F.col("model") == m, F.col("value")))

    j = table.groupBy("metric").agg(of(a).alias("value_a"), of(b).alias("value_b"))
    delta, none = F.col("value_b") - F.col("value_a"), F.lit(None).cast("double")
    row = F.struct("metric", "value_a", "value_b", delta.alias("delta"))
    keep = F.struct(F.lit("keep_linear").alias("metric"), none.alias("value_a"), none.alias("value_b"),
                    (F.abs(delta) < F.lit(margin)).cast("double").alias("delta"))
    rows = F.when(F.col("metric") == "auc", F.array(row, keep)).otherwise(F.array(row))
    return j.select(F.explode(rows).alias("r")).select("r.*")


def calibration_by(df: DataFrame, segment: str, label: str, prob: str) -> DataFrame:
    """Actual rate vs mean predicted probability per segment.

    Means rounded to 3 digits, then as percent to 1 digit (half to even).
    """
    g = df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"),
                                round_half_even(F.avg(label), 3).alias("actual_rate"),
                                round_half_even(F.avg(prob), 3).alias("predicted_prob"))
    return g.withColumns({"actual_pct": round_half_even(F.col("actual_rate") * 100.0, 1),
                          "predicted_pct": round_half_even(F.col("predicted_prob") * 100.0, 1)})
