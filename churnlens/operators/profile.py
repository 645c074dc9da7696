"""Profiles: missing counts, value counts, numeric summary, class means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions import round_half_even
from churnlens.operators.ranking import exact_quantiles
from churnlens.operators.sketches import column_summaries


def missing_counts(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """Nulls (and NaN for floats) per column in one aggregation (A1).

    Output ``(column, n_missing)``; by default only columns with a missing value.
    """
    kinds = dict(df.dtypes)

    def miss(c):
        m = F.col(c).isNull()
        return m | F.isnan(c) if kinds[c] in ("double", "float") else m

    wide = df.agg(*[F.count_if(miss(c)).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column", "n_missing")
    return long.where(F.col("n_missing") > 0) if only_positive else long


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percent per value, most frequent first (A2).

    The total is a scalar subquery over the grouped result (whose exchange the
    planner reuses), so no second scan and no single-task window.
    """
    g = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = g.select(F.sum("n")).scalar()
    return (g.select(F.col(column).alias("value"), "n", (F.col("n") * 100.0 / total).alias("pct"))
            .orderBy(F.desc("n"), "value"))


def describe(df: DataFrame, columns: Sequence[str], digits: int | None = 2,
             summaries: DataFrame | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max (A3).

    One row per column.  One scan makes the summaries (or they are given), one
    refines the quartiles, which are exact (``exact_quantiles``).
    ``DataFrame.summary`` is not used: its percentiles do not interpolate.
    ``digits`` rounds half to even.
    """
    summaries = column_summaries(df, columns) if summaries is None else summaries
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75], summaries)
    std = F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))
    out = summaries.join(q, "variable").select(
        "variable", F.col("n").cast("double").alias("count"), "mean", std.alias("std"), "min",
        F.col("q_25").alias("p25"), F.col("q_50").alias("p50"), F.col("q_75").alias("p75"), "max")
    if digits is not None:
        out = out.withColumns({c: round_half_even(c, digits)
                               for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]})
    return out


def class_means(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each numeric column per class."""
    return df.groupBy(label).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def summarize(df: DataFrame, label_text: str, numeric: Sequence[str]) -> DataFrame:
    """Dataset summary as one long table ``(section, item, value)``.

    Sections: ``census`` (rows, columns, numeric, string), ``missing`` (per
    column with nulls), ``label`` (count and percent per class), ``describe``
    (statistic per numeric column).  Composed of the single-pass operators.
    """
    from churnlens.operators.clean import census

    c = census(df)
    parts = [c.unpivot([], c.columns, "item", "value").select(
        F.lit("census").alias("section"), "item", F.col("value").cast("double").alias("value"))]
    parts.append(missing_counts(df).select(
        F.lit("missing").alias("section"), F.col("column").alias("item"),
        F.col("n_missing").cast("double").alias("value")))
    vc = value_counts(df, label_text)
    parts.append(vc.select(F.lit("label").alias("section"),
                           F.concat(F.col("value").cast("string"), F.lit(":n")).alias("item"),
                           F.col("n").cast("double").alias("value")))
    parts.append(vc.select(F.lit("label").alias("section"),
                           F.concat(F.col("value").cast("string"), F.lit(":pct")).alias("item"),
                           round_half_even("pct", 1).alias("value")))
    d = describe(df, numeric)
    stats = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    parts.append(d.unpivot(["variable"], stats, "stat", "value").select(
        F.lit("describe").alias("section"),
        F.concat_ws(":", "variable", "stat").alias("item"),
        F.col("value").cast(T.DoubleType()).alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
