"""Deterministic stratified split, folds and class weights.

Rows are ordered inside each class by ``md5(key:seed)`` (then the key), a
pseudo-random but reproducible order that any engine can recompute.  The
exact split takes the first ``ceil(test_fraction * n_class)`` rows of each
class; folds deal rows round-robin in the same order.

The leading digits of the md5 are a fixed function of the row and cut the
order of a class into equal buckets.  Counting rows per (class, bucket) places
every bucket in the order, so the split ranks only the one bucket per class
that holds the threshold, and folds rank inside buckets.  Nothing is sampled,
sorted globally or checkpointed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Leading hex digits that name a bucket: 65,536 buckets per class.
BUCKET_DIGITS = 4


def shuffle_key(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def _bucket_ends(df: DataFrame, label: str) -> DataFrame:
    """(_label, _bucket, _n, _end, _size): rows up to each bucket's end, and of the class.

    At most 65,536 rows per class, whatever the number of rows.
    """
    counts = df.groupBy(F.col(label).alias("_label"), "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_label")
    upto = w.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select("_label", "_bucket", "_n", F.sum("_n").over(upto).alias("_end"),
                         F.sum("_n").over(w).alias("_size"))


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.2,
                     seed: int = 42, method: str = "exact", out: str = "is_test") -> DataFrame:
    """Add ``is_test`` (0/1) keeping each class's share in both parts (M7).

    ``method='exact'``: per class exactly ``ceil(test_fraction * n_class)`` test
    rows; wide rows are not shuffled, as each compares its own (md5, key) with
    the last test row's of its class.  Rows that are equal in label and key
    share their fate.  ``method='hash'``: one pass: a row is test iff its hash
    falls below the fraction, so a class of n rows has ``fraction * n`` test
    rows give or take three times ``sqrt(n * f * (1 - f))``.  A null label is a
    class of its own.
    """
    if method == "hash":
        h = F.abs(F.xxhash64(F.col(key), F.lit(seed))) % F.lit(1_000_000)
        return df.withColumn(out, (h < F.lit(int(test_fraction * 1_000_000))).cast("int"))
    narrow = df.select(F.col(label).alias("_label"), shuffle_key(key, seed).alias("_h"), F.col(key).alias("_key"))
    narrow = narrow.withColumn("_bucket", F.substring("_h", 1, BUCKET_DIGITS))
    need = F.ceil(F.col("_size") * F.lit(test_fraction))
    ends = _bucket_ends(narrow, "_label").select(
        F.col("_label").alias("_l"), F.col("_bucket").alias("_b"), "_end",
        (F.col("_end") - F.col("_n")).alias("_start"), need.alias("_need"))
    # one row per class of the label, and so is ``limit``
    last = ends.where((F.col("_start") < F.col("_need")) & (F.col("_need") <= F.col("_end")))
    inside = narrow.join(F.broadcast(last), F.col("_label").eqNullSafe(F.col("_l"))
                         & (F.col("_bucket") == F.col("_b")))
    rank = F.row_number().over(Window.partitionBy("_l").orderBy("_h", "_key")) + F.col("_start")
    limit = inside.withColumn("_rank", rank).where(F.col("_rank") == F.col("_need")).select(
        "_l", F.struct(F.col("_h").alias("h"), F.col("_key").alias("k")).alias("_limit"))
    own = F.struct(shuffle_key(key, seed).alias("h"), F.col(key).alias("k"))
    joined = df.join(F.broadcast(limit), F.col(label).eqNullSafe(F.col("_l")), "left")
    return joined.withColumn(out, F.coalesce(own <= F.col("_limit"), F.lit(False)).cast("int")).drop("_l", "_limit")


def assign_folds(df: DataFrame, label: str, key: str, n_folds: int = 5, seed: int = 42,
                 out: str = "fold") -> DataFrame:
    """Stratified fold number 0..n_folds-1, dealt round-robin per class (M8).

    One hash exchange of the rows by (class, bucket); the bucket's place in
    the class comes from the counts.
    """
    rows = df.withColumn("_h", shuffle_key(key, seed)).withColumn("_bucket", F.substring("_h", 1, BUCKET_DIGITS))
    ends = _bucket_ends(rows, label).select("_label", F.col("_bucket").alias("_b"),
                                            (F.col("_end") - F.col("_n")).alias("_start"))
    rank = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_h", key)) - 1
    ranked = rows.withColumn("_rank", rank).join(
        ends, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_bucket") == F.col("_b")))
    return ranked.withColumn(out, F.pmod(F.col("_rank") + F.col("_start"), F.lit(n_folds)).cast("int")) \
                 .drop("_h", "_bucket", "_rank", "_label", "_b", "_start")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Class balance in one aggregation.

    ``pos_weight`` = negatives / positives (the boosted model's weight);
    ``w_pos``, ``w_neg`` = n / (2 n_class) (balanced weights of the linear model).
    """
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n_pos"))
    n, p = F.col("n"), F.col("n_pos")
    return agg.select("n", "n_pos", (n - p).alias("n_neg"),
                      F.try_divide((n - p).cast("double"), p).alias("pos_weight"),
                      F.try_divide(n.cast("double"), p * 2).alias("w_pos"),
                      F.try_divide(n.cast("double"), (n - p) * 2).alias("w_neg"))


def with_weights(df: DataFrame, label: str, scheme: str = "balanced",
                 out: str = "weight", reference: DataFrame | None = None) -> DataFrame:
    """Add a weight column from class counts of ``reference`` (default ``df``).

    ``balanced``: n/(2 n_class) per class; ``pos``: neg/pos for positives,
    1 for negatives.  Two numbers reach the driver; the column is a literal
    ``when``.
    """
    w = class_weights(reference if reference is not None else df, label).first()
    if scheme == "balanced":
        expr = F.when(F.col(label) == 1, F.lit(w["w_pos"])).otherwise(F.lit(w["w_neg"]))
    else:
        expr = F.when(F.col(label) == 1, F.lit(w["pos_weight"])).otherwise(F.lit(1.0))
    return df.withColumn(out, expr.cast("double"))
