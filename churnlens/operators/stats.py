"""Correlation matrix and kernel density curves."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.comoments import comoments, pearson


# Beyond 40 bandwidths exp(-z^2/2) underflows to exactly 0.0 in double
# precision (it does from about 38.6), so skipping those grid points changes
# no bit of the result.
KDE_CUTOFF_Z = 40.0


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix, pairwise-complete, as ``(x, y, r)`` for all ordered pairs.

    From one co-moment table (``operators/comoments.py``); a pair with a
    constant column has a null r.
    """
    return pearson(comoments(df, columns))


def correlation_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Pearson r of ``target`` with each column, pairwise-complete: ``(feature, r)``.

    One aggregation with three moments per column (no all-pairs matrix).
    """
    aggs = []
    for i, c in enumerate(columns):
        both = F.col(target).isNotNull() & F.col(c).isNotNull()
        xt = F.when(both, F.col(target).cast("double"))
        xc = F.when(both, F.col(c).cast("double"))
        aggs += [F.covar_samp(xt, xc).alias(f"c{i}"), F.stddev_samp(xt).alias(f"st{i}"),
                 F.stddev_samp(xc).alias(f"sc{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"),
                     F.try_divide(F.col(f"c{i}"), F.col(f"st{i}") * F.col(f"sc{i}")).alias("r"))
            for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.feature", "p.r")


def _grid(vals: DataFrame, points: int) -> DataFrame:
    """Per class: rows, bandwidth, and the grid's first point and step (broadcast: one row per class label)."""
    stats = (vals.groupBy("class")
             .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"),
                  F.stddev_samp("v").alias("sd"))
             .where((F.col("n") > 1) & (F.col("sd") > 0)))
    span = F.col("mx") - F.col("mn")
    grid = stats.select(
        "class", "n",
        (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"),
        (F.col("mn") - F.lit(0.5) * span).alias("lo"),
        (((F.col("mx") + F.lit(0.5) * span) - (F.col("mn") - F.lit(0.5) * span))
         / F.lit(float(points - 1))).alias("step"))
    return F.broadcast(grid)


def binned_kde(df: DataFrame, column: str, by: str, points: int = 1000) -> DataFrame:
    """The curve of ``kde`` by linear binning: ``(class, point, x, density, error)``.

    A value shares its weight between its two neighbouring grid points by
    distance, which leaves at most ``points`` weights per class; the density is
    their convolution with the kernel.  Work is rows + points * points per
    class, whatever the number of distinct values.  Sharing a value replaces
    the kernel by its chord between two grid points, so the density is off by
    at most step^2 / 8 times the kernel's largest curvature, 1 / (h^3 sqrt(2 pi)):
    that bound is ``error``.
    """
    x = F.col(column).cast("double")
    vals = (df.select(F.col(by).alias("class"), x.alias("v"))
            .where(F.col("v").isNotNull() & ~F.isnan("v")))
    grid = _grid(vals, points)
    place = (F.col("v") - F.col("lo")) / F.col("step")
    low = F.least(F.floor(place), F.lit(points - 2)).cast("int")
    shares = vals.join(grid, "class").select("class", F.explode(F.array(
        F.struct(low.alias("j"), (1.0 - (place - low)).alias("w")),
        F.struct((low + 1).alias("j"), (place - low).alias("w")))).alias("s"))
    weights = shares.groupBy("class", "s.j").agg(F.sum("s.w").alias("w"))
    # at most `points` rows of a class: one array
    rows = weights.groupBy("class").agg(F.collect_list(F.struct("j", "w")).alias("weights")).join(grid, "class")
    rows = rows.select("class", "n", "h", "lo", "step", "weights", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    z = lambda e: (F.col("point") - e["j"]) * F.col("step") / F.col("h")
    total = F.aggregate("weights", F.lit(0.0), lambda a, e: a + e["w"] * F.exp(F.lit(-0.5) * z(e) * z(e)))
    root = math.sqrt(2 * math.pi)
    return rows.select("class", "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
                       (total / (F.col("n") * F.col("h") * F.lit(root))).alias("density"),
                       (F.col("step") * F.col("step") / (8.0 * root * F.pow("h", F.lit(3.0)))).alias("error"))


def kde(df: DataFrame, column: str, by: str, points: int = 1000,
        prebin: float | None = None) -> DataFrame:
    """Gaussian kernel density of ``column`` per class of ``by``.

    Bandwidth by Scott's rule, ``std_samp * n^(-1/5)``; ``points`` grid points
    evenly from ``min - range/2`` to ``max + range/2`` of each class (the
    plotting default the reference relied on).  Output
    ``(class, point, x, density)``.

    Plan: values collapse to ``(class, value, weight)``; each distinct value
    is expanded only to the grid points within ``KDE_CUTOFF_Z`` bandwidths
    (exactly the points where its kernel is non-zero), then one aggregation by
    ``(class, point)``.  Work is distinct values x points-in-reach, not rows x
    grid.  ``prebin`` (a width) rounds values to its multiples first, so that
    continuous data have at most range / prebin distinct values; it moves a
    value by prebin / 2 at most, and the density by 0.121 * prebin / h^2 at
    most (h the bandwidth; 0.242 bounds the kernel's slope).
    """
    x = F.col(column).cast("double")
    if prebin:
        x = F.rint(x / F.lit(prebin)) * F.lit(prebin)
    vals = (df.select(F.col(by).alias("class"), x.alias("v"))
            .where(F.col("v").isNotNull() & ~F.isnan("v")))
    weights = vals.groupBy("class", "v").agg(F.count(F.lit(1)).alias("w"))
    grid = _grid(vals, points)

    reach = F.lit(KDE_CUTOFF_Z) * F.col("h")
    j_lo = F.greatest(F.lit(0), F.ceil((F.col("v") - reach - F.col("lo")) / F.col("step")).cast("int"))
    j_hi = F.least(F.lit(points - 1),
                   F.floor((F.col("v") + reach - F.col("lo")) / F.col("step")).cast("int"))
    contrib = (weights.join(grid, "class")
               .where(j_lo <= j_hi)
               .select("class", "v", "w", "h", "lo", "step",
                       F.explode(F.sequence(j_lo, j_hi)).alias("point"))
               .select("class", "point",
                       ((F.col("lo") + F.col("point") * F.col("step") - F.col("v")) / F.col("h"))
                       .alias("z"), "w"))
    contrib = contrib.select("class", "point",
                             (F.col("w") * F.exp(F.lit(-0.5) * F.col("z") * F.col("z"))).alias("k"))
    # every grid point appears, also where no value reaches it (density 0)
    zeros = grid.select("class", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
                        F.lit(0.0).alias("k"))
    summed = contrib.unionByName(zeros).groupBy("class", "point").agg(F.sum("k").alias("s"))
    return (summed.join(grid, "class")
            .select("class", "point",
                    (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
                    (F.col("s") / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))))
                    .alias("density")))
