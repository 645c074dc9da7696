"""Column summaries that merge: moments, ends and a KLL quantile sketch per column.

One scan sketches all columns in ``SALTS`` parts, a second small aggregation
merges the parts, so no task reads a whole column.  The stored summary answers
quantiles within the sketch's rank error at once; summaries of new data are
merged with it and nothing is scanned again.  Exact quantiles start from it
(``ranking.exact_quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import materialize

SALTS = 64
SKETCH_K = 4_096
# A KLL sketch of parameter k misses a rank by more than about 2 / k**0.9 of all rows once in a hundred times.
RANK_ERROR = 2.0 / SKETCH_K**0.9


def number(column: str) -> Column:
    """The column as a double; NaN counts as missing."""
    x = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(x), x)


def _parts(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """(variable, n, mean, m2, min, max, sketch) per column and part of the scan."""
    rows = df.select((F.spark_partition_id() % SALTS).alias("_part"), *[number(c).alias(f"x{i}") for i, c in enumerate(columns)])
    wide = rows.groupBy("_part").agg(*[f(F.col(f"x{i}")).alias(f"{n}{i}") for i in range(len(columns)) for n, f in (
        ("n", F.count), ("mean", F.avg), ("var", F.var_pop), ("min", F.min), ("max", F.max),
        ("sketch", lambda x: F.kll_sketch_agg_double(x, k)))])
    each = [F.struct(F.lit(c).alias("variable"), F.col(f"n{i}").alias("n"), F.col(f"mean{i}").alias("mean"),
                     (F.col(f"var{i}") * F.col(f"n{i}")).alias("m2"), F.col(f"min{i}").alias("min"),
                     F.col(f"max{i}").alias("max"), F.col(f"sketch{i}").alias("sketch")) for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*each)).alias("c")).select("c.*")


def _merged(parts: DataFrame) -> DataFrame:
    """Parts of the same variable as one row."""
    w = Window.partitionBy("variable")
    mean = F.sum(F.col("n") * F.col("mean")).over(w) / F.nullif(F.sum("n").over(w), F.lit(0))
    parts = parts.withColumn("all", mean)
    away = F.col("mean") - F.col("all")
    sketch = F.when(F.col("n") > 0, F.col("sketch"))
    return parts.groupBy("variable").agg(
        F.sum("n").alias("n"), F.max("all").alias("mean"), F.sum(F.col("m2") + F.col("n") * away * away).alias("m2"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double(sketch).alias("sketch"))


def column_summaries(df: DataFrame, columns: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """Stored ``(variable, n, mean, m2, min, max, sketch)``, one row per column.

    ``m2`` is the sum of squared deviations.  Missing values and NaN do not
    count; a column without a value has n 0 and nulls.
    """
    return materialize(_merged(_parts(df, list(columns), k)), "summaries")


def merge_summaries(*summaries: DataFrame) -> DataFrame:
    """One stored summary of all the rows that several summaries stand for."""
    return materialize(_merged(reduce(DataFrame.unionByName, summaries)), "summaries")


def sketched_quantiles(summaries: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(variable, q)``: array of the sketches' values at the given ranks (an actual value of the column)."""
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    return summaries.where("n > 0").select("variable", F.kll_sketch_get_quantile_double("sketch", ranks).alias("q"))
