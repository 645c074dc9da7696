"""Churn rates overall, by category and by bin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions import cut_index, cut_label
from churnlens.operators.ranking import running_sums
from churnlens.session import materialize


def overall_rate(df: DataFrame, label: str) -> DataFrame:
    """Mean of a 0/1 label as percent, with the row count (A4)."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  (F.avg(label) * 100.0).alias("churn_rate"))


def rate_by(df: DataFrame, columns: Sequence[str] | str, label: str) -> DataFrame:
    """Rate of a 0/1 label per level of one or several columns, in one pass (A5).

    Output ``(variable, level, n, churn_rate, baseline, lift)`` sorted by
    variable, rate descending, level.  Several columns are unpivoted into
    ``(variable, level)`` and aggregated by a single hash aggregation, which
    combines map-side, so hot levels never gather in one task.  The baseline
    is the overall rate of all rows (null levels included, as a plain mean
    would), taken from the small aggregated result rather than a second scan.
    Rows whose level is null form no group (pandas ``groupby`` semantics).
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    long = (df.select(F.col(label).cast("double").alias("_y"),
                      *[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot("_y", columns, "variable", "level"))
    g = long.groupBy("variable", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("_s"))
    base = g.groupBy(F.col("variable").alias("_v")).agg((F.sum("_s") / F.sum("n") * 100.0).alias("baseline"))
    rate = F.col("_s") / F.col("n") * 100.0
    return (g.join(F.broadcast(base), F.col("variable") == F.col("_v"))  # one row per column
            .where(F.col("level").isNotNull())
            .select("variable", "level", "n",
                    rate.alias("churn_rate"),
                    "baseline",
                    (rate / F.col("baseline")).alias("lift"))
            .orderBy("variable", F.desc("churn_rate"), "level"))


def rate_by_bin(df: DataFrame, column: str, edges: Sequence[float],
                labels: Sequence[str], label: str) -> DataFrame:
    """Rate and size per right-closed bin; rows outside every bin drop out.

    Output ``(bin_idx, bin_label, n, churn_rate)`` in bin order; empty bins do
    not appear.
    """
    idx = cut_index(column, edges)
    return (df.select(idx.alias("bin_idx"), F.col(label).alias("_y"))
            .where(F.col("bin_idx").isNotNull())
            .groupBy("bin_idx")
            .agg(F.count(F.lit(1)).alias("n"), (F.avg("_y") * 100.0).alias("churn_rate"))
            .select("bin_idx", cut_label("bin_idx", labels).alias("bin_label"), "n", "churn_rate")
            .orderBy("bin_idx"))


def rate_summary(df: DataFrame, tenure: str, edges: Sequence[float], labels: Sequence[str],
                 label: str, columns: Sequence[str]) -> DataFrame:
    """Tenure-bin rates plus per-level rates of ``columns`` as one long table (R2).

    Output ``(panel, item, ord, n, churn_rate)``.  ``ord`` keeps bin order for
    the tenure panel and rate order (descending) for the category panels.
    """
    bins = rate_by_bin(df, tenure, edges, labels, label).select(
        F.lit(tenure).alias("panel"), F.col("bin_label").alias("item"),
        F.col("bin_idx").alias("ord"), "n", "churn_rate")
    cats = materialize(rate_by(df, columns, label), "rates")
    # place of each distinct rate, then of the level among equal rates: no
    # task sees all levels of a column
    rates = cats.groupBy("variable", "churn_rate").agg(F.count(F.lit(1)).alias("levels"))
    rates = running_sums(rates, "churn_rate", ["levels"], ["variable"], descending=True)
    tie = F.row_number().over(Window.partitionBy("variable", "churn_rate").orderBy("level"))
    cats = cats.join(rates, ["variable", "churn_rate"]).select(
        F.col("variable").alias("panel"), F.col("level").alias("item"),
        (F.col("levels_cum") - F.col("levels") + tie).cast("int").alias("ord"), "n", "churn_rate")
    return bins.unionByName(cats)
