"""Explanations and top-k.

Per-row contributions live in an ``ARRAY<DOUBLE>`` column aligned with an
ordered feature-name list; the long form ``(key, feature, value, shap)`` comes
from ``posexplode``.  Per-row top-k is an array sort inside the row (no
shuffle).  The tree-model contributions are in ``churnlens.operators.treeshap``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions import decode
from churnlens.schema import HIGH_RISK_P, LOW_RISK_P
from churnlens.session import materialize


def linear_contributions(coefficients: Sequence[float], features: Sequence[str],
                         means: Sequence[float] | None = None) -> Column:
    """SHAP values of a linear log-odds model: ``coef_j * (x_j - mean_j)``.

    With standardised features the means are 0.  Pure column expression.
    """
    means = means or [0.0] * len(features)
    return F.array(*[(F.col(f).cast("double") - F.lit(float(m))) * F.lit(float(c))
                     for f, c, m in zip(features, coefficients, means)])


def to_long(df: DataFrame, key: str, features: Sequence[str], shap: str = "shap") -> DataFrame:
    """``(key, feature, value, shap)`` rows from an array column (M23 input)."""
    names = F.array(*[F.lit(f) for f in features])
    values = F.array(*[F.col(f).cast("double") for f in features])
    z = F.arrays_zip(names.alias("feature"), values.alias("value"), F.col(shap).alias("shap"))
    return df.select(key, F.explode(z).alias("e")).select(key, "e.feature", "e.value", "e.shap")


def mean_abs_shap(long: DataFrame) -> DataFrame:
    """Global importance: mean |shap| per feature, descending."""
    return (long.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
            .orderBy(F.desc("mean_abs_shap"), "feature"))


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    """First ``n`` features of ``mean_abs_shap`` (T4)."""
    return importance.orderBy(F.desc("mean_abs_shap"), "feature").limit(n)


def named_features(importance: DataFrame, meanings: Mapping[str, str], n: int = 10) -> DataFrame:
    """``(rank, feature, mean_abs_shap, meaning)`` of the first ``n`` features; an unknown one has an empty meaning."""
    order = Window.orderBy(F.desc("mean_abs_shap"), "feature")  # over n rows
    return top_features(importance, n).select(
        F.row_number().over(order).alias("rank"), "feature", "mean_abs_shap", decode("feature", dict(meanings)).alias("meaning"))


def contribution_cloud(long: DataFrame, n: int = 15) -> DataFrame:
    """Every row's contribution for the top-``n`` features.

    The top list has ``n`` rows, so the semi-join broadcasts a bounded side.
    """
    top = top_features(mean_abs_shap(long), n).select("feature")
    return long.join(F.broadcast(top), "feature", "left_semi")


def top_in_row(features: Sequence[str], shap: str = "shap", k: int = 12) -> Column:
    """The ``k`` largest |contributions| of one row with name and value (T5).

    Array of ``struct(feature, value, shap)``, sorted by |shap| descending,
    ties by feature name; an in-row sort, so no shuffle for any row count.
    """
    names = F.array(*[F.lit(f) for f in features])
    values = F.array(*[F.col(f).cast("double") for f in features])
    z = F.arrays_zip(names.alias("feature"), values.alias("value"), F.col(shap).alias("shap"))

    def cmp(a, b):
        da, db = F.abs(a["shap"]), F.abs(b["shap"])
        return (F.when(da > db, -1).when(da < db, 1)
                .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1)
                .otherwise(0))

    return F.slice(F.array_sort(z, cmp), 1, k)


def top_abs(df: DataFrame, column: str, n: int = 20, tie: str | None = None) -> DataFrame:
    """Keep the ``n`` largest |value| rows, then order by signed value."""
    order = [F.desc(F.abs(F.col(column)))] + ([F.col(tie)] if tie else [])
    return df.orderBy(*order).limit(n).orderBy(column, *([tie] if tie else []))


def top_signed(df: DataFrame, column: str, n: int = 5, tie: str | None = None) -> DataFrame:
    """Strongest ``n`` positive and ``n`` negative values, tagged by ``sign``."""
    t = [F.col(tie)] if tie else []
    pos = df.where(F.col(column) > 0).orderBy(F.desc(column), *t).limit(n) \
            .withColumn("sign", F.lit("positive"))
    neg = df.where(F.col(column) < 0).orderBy(F.col(column), *t).limit(n) \
            .withColumn("sign", F.lit("negative"))
    return pos.unionByName(neg)


def pick_examples(df: DataFrame, key: str, prob: str, hi: float = HIGH_RISK_P,
                  lo: float = LOW_RISK_P) -> DataFrame:
    """One high-risk and one low-risk customer.

    High: the smallest key with ``prob > hi``, or else the row of the maximum
    probability; low: the smallest key with ``prob < lo``, or else the minimum.
    "First" is by key, since a distributed table has no row order.  One
    aggregation; output ``(kind, key, prob)``.
    """
    row = F.struct(F.col(key).alias("k"), F.col(prob).alias("p"))
    a = df.agg(
        F.min_by(row, F.when(F.col(prob) > hi, F.col(key))).alias("hi_first"),
        F.min_by(row, F.struct(-F.col(prob), F.col(key))).alias("hi_max"),
        F.min_by(row, F.when(F.col(prob) < lo, F.col(key))).alias("lo_first"),
        F.min_by(row, F.struct(F.col(prob), F.col(key))).alias("lo_min"),
        F.count_if(F.col(prob) > hi).alias("n_hi"), F.count_if(F.col(prob) < lo).alias("n_lo"))
    hi_pick = F.when(F.col("n_hi") > 0, F.col("hi_first")).otherwise(F.col("hi_max"))
    lo_pick = F.when(F.col("n_lo") > 0, F.col("lo_first")).otherwise(F.col("lo_min"))
    return a.select(F.explode(F.array(
        F.struct(F.lit("high").alias("kind"), hi_pick["k"].alias(key), hi_pick["p"].alias(prob)),
        F.struct(F.lit("low").alias("kind"), lo_pick["k"].alias(key), lo_pick["p"].alias(prob)),
    )).alias("e")).select("e.*")


def explain_customers(scored: DataFrame, key: str, prob: str, features: Sequence[str],
                      shap: str = "shap", k: int = 12, all_rows: bool = False) -> DataFrame:
    """Probability and top-``k`` contributions for T6's two customers.

    ``all_rows=True`` explains every customer (same in-row sort, no shuffle).
    """
    ex = scored.select(key, prob, top_in_row(features, shap, k).alias("top"))
    if all_rows:
        return ex
    picks = pick_examples(scored, key, prob).select("kind", key)  # two rows
    return ex.join(F.broadcast(picks), key)


def example_rows(scored: DataFrame, key: str, prob: str) -> DataFrame:
    """The rows of T6's two customers with their ``kind``, as a stored table.

    For models whose contributions are costly: pick on the scored rows, then
    explain these rows only.
    """
    picks = pick_examples(scored, key, prob).select("kind", F.col(key).alias("_picked"))
    return materialize(scored.join(F.broadcast(picks), F.col(key) == F.col("_picked")).drop("_picked"), "examples")
