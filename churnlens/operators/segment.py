"""Segmentation: k-means with restarts, k sweep, silhouette, 2-D projection,
segment profiles, cross-tabs and personas (M2-M6, J1, A10, A11, P17, T7).

The feature vectors are stored once as blocks; every step of every k-means fit
is one scan of them (``operators/kmeans.py``).  Cluster statistics that reach
the driver are k x d numbers per fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions import band, decode, round_half_even
from churnlens.operators.blocks import loaded, stored_blocks
from churnlens.operators.kmeans import SegmentFit, best_of, fit_many
from churnlens.operators.silhouette import silhouette_of_fits
from churnlens.schema import PERSONA_ACTIONS, PERSONA_BANDS, PERSONA_DEFAULT


# --- profiles ----------------------------------------------------------------

def profile_segments(df: DataFrame, segment: str, tenure: str, monthly: str, total: str,
                     senior: str, label: str) -> DataFrame:
    """Size, means and shares per segment in one aggregation (A10).

    Means are rounded to 2 digits; senior share and churn rate are rounded to
    2 digits as fractions, then shown as percent to 1 digit (so churn rates
    have whole-percent resolution, as the reference reports them).
    """
    g = df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n"),
        round_half_even(F.avg(tenure), 2).alias("tenure_mean"),
        round_half_even(F.avg(monthly), 2).alias("monthly_mean"),
        round_half_even(F.avg(total), 2).alias("total_mean"),
        round_half_even(F.avg(senior), 2).alias("_senior"),
        round_half_even(F.avg(label), 2).alias("_churn"))
    return g.select(segment, "n", "tenure_mean", "monthly_mean", "total_mean",
                    round_half_even(F.col("_senior") * 100.0, 1).alias("senior_pct"),
                    round_half_even(F.col("_churn") * 100.0, 1).alias("churn_rate"))


def crosstab_pct(df: DataFrame, segment: str, column: str, levels: Sequence[str]) -> DataFrame:
    """Counts per segment x level with empty cells 0, and row percent.

    ``levels`` are passed explicitly so the pivot needs no extra job to find
    them; output columns ``n_<level>`` and ``pct_<level>`` (1 digit).
    """
    levels = list(levels)
    wide = (df.groupBy(segment).pivot(column, levels).agg(F.count(F.lit(1)))
            .na.fill(0, subset=levels))
    total = sum((F.col(f"`{lv}`") for lv in levels), F.lit(0))
    return wide.select(segment,
                       *[F.col(f"`{lv}`").cast("long").alias(f"n_{lv}") for lv in levels],
                       *[round_half_even(F.col(f"`{lv}`") * 100.0 / total, 1).alias(f"pct_{lv}")
                         for lv in levels])


def assign_personas(profile: DataFrame, rate: str = "churn_rate") -> DataFrame:
    """Persona and action from the rounded churn rate (M6); strict '>' bands."""
    persona = band(rate, PERSONA_BANDS, PERSONA_DEFAULT)
    return profile.withColumn("persona", persona) \
                  .withColumn("action", decode("persona", PERSONA_ACTIONS))


def crosstab(df: DataFrame, segment: str, column: str) -> DataFrame:
    """``(segment, level, n, pct)`` for the level pairs that occur (A11, long form).

    No list of levels is needed and none is left out, however many there are;
    percent of the segment's rows with a level, 1 digit.  Null levels form no
    group.
    """
    g = (df.where(F.col(column).isNotNull()).groupBy(F.col(segment), F.col(column).cast("string").alias("level"))
         .agg(F.count(F.lit(1)).alias("n")))
    total = g.groupBy(F.col(segment).alias("_seg")).agg(F.sum("n").alias("_t"))
    return (g.join(total, F.col(segment).eqNullSafe(F.col("_seg")))
            .select(segment, "level", "n", round_half_even(F.col("n") * 100.0 / F.col("_t"), 1).alias("pct")))


def canonical_order(labelled: DataFrame, raw: str, label: str, out: str = "segment_id") -> DataFrame:
    """``(raw, segment_id)``: cluster ids 1..k by churn rate desc, size desc, id.

    The window runs over one row per segment.
    """
    stats = labelled.where(F.col(raw).isNotNull()).groupBy(raw).agg(F.avg(label).alias("r"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.desc("r"), F.desc("n"), raw)
    return stats.select(raw, F.row_number().over(order).cast("int").alias(out))


def canonical_ids(labelled: DataFrame, raw: str, label: str, out: str = "segment_id") -> DataFrame:
    """Renumber arbitrary cluster ids by ``canonical_order``.

    Raw ids depend on the random start; the report refers to "the riskiest
    segment", which this order makes stable.  The rows are joined with the
    one-row-per-segment table; a null raw id stays null.
    """
    ids = canonical_order(labelled, raw, label, out).withColumnRenamed(raw, "_raw")
    return labelled.join(ids, F.col(raw) == F.col("_raw"), "left").drop("_raw")


# --- k-means -------------------------------------------------------------

def _vectors(features: DataFrame, features_col: str):
    """The feature vectors as stored blocks, loaded into the executors."""
    return loaded(stored_blocks(features, vector_to_array(F.col(features_col)), "vectors"))


def fit_segments(features: DataFrame, k: int, n_init: int = 10, seed: int = 42,
                 max_iter: int = 300, tol: float = 1e-4, features_col: str = "features") -> SegmentFit:
    """Best of ``n_init`` k-means starts by inertia (M2).

    300 iterations and ``tol`` as in the reference (total squared centre shift
    relative to the mean feature variance).  Starts use seeds
    ``seed .. seed + n_init - 1`` and share their scans.
    """
    blocks = _vectors(features, features_col)
    try:
        return best_of(fit_many(blocks, [(k, seed + i) for i in range(n_init)], max_iter, tol))
    finally:
        blocks.unpersist()


def squared_silhouette(df: DataFrame, features_col: str = "features", prediction: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distance, from per-cluster sums (linear cost).

    Another number than the Euclidean one of ``operators/silhouette.py``, by
    which the sweep chooses k.
    """
    ev = ClusteringEvaluator(featuresCol=features_col, predictionCol=prediction,
                             metricName="silhouette", distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(df))


def sweep_k(features: DataFrame, k_values: Sequence[int] = tuple(range(2, 9)), n_init: int = 10,
            seed: int = 42, max_iter: int = 300, tol: float = 1e-4,
            features_col: str = "features", per_cluster: int | None = None) -> tuple[DataFrame, SegmentFit]:
    """Inertia and Euclidean silhouette per k; the winner has the largest silhouette, the smaller k on ties.

    All (k, start) fits share one scan per step; one pass over all pairs of rows
    gives the silhouettes of the best fit of every k (``per_cluster`` rows of a
    cluster stand for it where that is given).  Returns the ``(k, inertia,
    silhouette, standard_error, best)`` table and the winning fit.
    """
    k_values = list(k_values)
    blocks = _vectors(features, features_col)
    try:
        fits = fit_many(blocks, [(k, seed + i) for k in k_values for i in range(n_init)], max_iter, tol)
        best = [best_of([f for f in fits if f.k == k]) for k in k_values]
        scores = silhouette_of_fits(blocks, best, per_cluster, seed)
    finally:
        blocks.unpersist()
    rows = [(f.k, f.inertia, s, e) for f, (s, e) in zip(best, scores)]
    best_k = min(rows, key=lambda r: (-r[2], r[0]))[0]
    table = features.sparkSession.createDataFrame([(*r, r[0] == best_k) for r in rows],
                                                  "k int, inertia double, silhouette double, standard_error double, best boolean")
    return table, best[k_values.index(best_k)]


def project_2d(df: DataFrame, features_col: str = "features", key: str | None = None,
               extra: Sequence[str] = ()) -> tuple[DataFrame, list[float]]:
    """Two principal components and their explained-variance shares (M5).

    Spark's PCA centres when fitting but not when projecting, so the input
    should be standardised (mean 0) first.  Signs are fixed so the largest
    absolute loading of each component is positive.
    """
    model = PCA(k=2, inputCol=features_col, outputCol="_pc").fit(df)
    pc = model.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(F.col("_pc"))
    out = model.transform(df).select(
        *([key] if key else []), *extra,
        (arr[0] * F.lit(signs[0])).alias("pc1"), (arr[1] * F.lit(signs[1])).alias("pc2"))
    return out, [float(x) for x in model.explainedVariance.toArray()]
