"""Global running totals and order statistics without a single-partition window.

``Window.orderBy(x)`` with no ``partitionBy`` moves every row into one task.
Running totals cut the order into slices and add each slice's offset; exact
quantiles order only the values in a bracket around each target rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.sketches import SKETCH_K, column_summaries, number, sketched_quantiles
from churnlens.session import materialize

_SLICE = "_slice"
# percentile_approx returns a value whose rank is off by at most n / ACCURACY.
ACCURACY = 10_000
# A bracket reaches so many times the sketch's usual rank error to either side.
MARGIN = 3.0
# Rows of a slice: so many are ordered by one task.
SLICE_ROWS = 500_000


def _default_slices(df: DataFrame) -> int:
    return max(1, -(-df.count() // SLICE_ROWS))  # the rows of a stored table: read from its footers


def running_sums(df: DataFrame, key: str, sum_cols: Sequence[str], groups: Sequence[str] = (),
                 slices: int | None = None, suffix: str = "_cum", descending: bool = False) -> DataFrame:
    """Add inclusive running sums of ``sum_cols`` in the order of one numeric key.

    ``df`` is stored (``session.materialize``) and unique in (groups, key);
    running sums restart for each group.  Slice bounds (at most ``slices - 1``
    numbers) come from one ``percentile_approx`` pass over ``df``; a
    ``Bucketizer`` maps every row to its slice, so the slice is a fixed
    function of the row, and one hash exchange on it serves both the window
    inside the slice and the slice totals.  The offsets table has one row per
    (group, slice); groups are few (models, classes).
    """
    groups, n = list(groups), slices or _default_slices(df)
    probs = [i / n for i in range(1, n)]
    bounds = (df.agg(F.percentile_approx(F.col(key).cast("double"), probs, ACCURACY)).first()[0] or []) if probs else []
    splits = [float("-inf"), *sorted({float(b) for b in bounds}), float("inf")]
    if len(splits) > 2:
        cut = Bucketizer(splits=splits, inputCol="_k", outputCol="_b").transform(
            df.withColumn("_k", F.col(key).cast("double")))
        cut = cut.withColumn(_SLICE, F.col("_b").cast("int")).drop("_b", "_k")
    else:
        cut = df.withColumn(_SLICE, F.lit(0))
    if descending:
        cut = cut.withColumn(_SLICE, F.lit(len(splits)) - F.col(_SLICE))
    if n > 1:
        cut = cut.repartition(n, *groups, _SLICE)
    order = F.desc(key) if descending else F.col(key)
    local_w = (Window.partitionBy(*groups, _SLICE).orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = cut.withColumns({c + suffix: F.sum(c).over(local_w) for c in sum_cols})
    totals = cut.groupBy(*groups, _SLICE).agg(*[F.sum(c).alias(c) for c in sum_cols])
    before = Window.partitionBy(*groups).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*groups, _SLICE, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias("_off_" + c)
                                               for c in sum_cols])
    joined = local.join(F.broadcast(offsets), [*groups, _SLICE])  # one row per group and slice
    return joined.select(*df.columns, *[(F.col(c + suffix) + F.col("_off_" + c)).alias(c + suffix) for c in sum_cols])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    summaries: DataFrame | None = None, k: int = SKETCH_K) -> DataFrame:
    """Linearly interpolated quantiles (pandas/NumPy 'linear', DuckDB quantile_cont).

    Output: one row per column with ``variable`` and ``q_<p>`` columns; nulls
    and NaN do not count.  A quantile lies between two neighbouring ranks.
    The sketches of ``summaries`` (made by one scan if not given) bracket both
    ranks.  A second scan counts every value inside a bracket and all values
    between two brackets as one; running sums over these counts place the
    ranks.  A rank outside its bracket (the sketch erred by more than
    ``MARGIN`` times its usual error) is seen as such, and the scan is repeated
    with brackets eight times as wide.
    """
    columns = list(columns)
    summaries = column_summaries(df, columns, k) if summaries is None else summaries
    size = {r["variable"]: r["n"] for r in summaries.select("variable", "n").collect()}
    spark = df.sparkSession
    names = "variable string, " + ", ".join(f"q_{_ptag(p)} double" for p in probs)
    ranks = {(c, p): int((size[c] - 1) * p) for c in columns if size[c] for p in probs}
    found: dict[tuple[str, int], float] = {}
    reach = MARGIN * 2.0 / k**0.9
    while True:
        todo = [(c, p) for (c, p), r in ranks.items() if (c, r) not in found or (c, min(r + 1, size[c] - 1)) not in found]
        if not todo:
            break
        found |= _values_at(df, summaries, size, ranks, todo, reach)
        reach *= 8.0
    rows = []
    for c in columns:
        row = []
        for p in probs if size[c] else ():
            r, pos = ranks[c, p], (size[c] - 1) * p
            low, high = found[c, r], found[c, min(r + 1, size[c] - 1)]
            row.append(low + (high - low) * (pos - r))
        rows.append((c, *(row or [None] * len(probs))))
    return spark.createDataFrame(rows, names)


def _values_at(df: DataFrame, summaries: DataFrame, size: dict[str, int], ranks: dict[tuple[str, float], int],
               todo: list[tuple[str, float]], reach: float) -> dict[tuple[str, int], float]:
    """(column, rank) -> value for the ranks at ``todo`` and the next ones, where the brackets hold them."""
    wanted: dict[str, list[int]] = {}
    for c, p in todo:
        wanted.setdefault(c, []).extend({ranks[c, p], min(ranks[c, p] + 1, size[c] - 1)})
    ends = sorted({min(1.0, max(0.0, r / size[c] + s)) for c, rs in wanted.items() for r in rs for s in (-reach, reach)})
    at = {r["variable"]: r["q"] for r in sketched_quantiles(summaries, ends).collect()}
    limits = {r["variable"]: (r["min"], r["max"]) for r in summaries.select("variable", "min", "max").collect()}
    keys, between = [], {}
    for c, rs in wanted.items():
        spans: list[list[float]] = []
        for r in sorted(rs):
            low, high = (min(1.0, max(0.0, r / size[c] + s)) for s in (-reach, reach))
            a = limits[c][0] if low == 0.0 else at[c][ends.index(low)]
            b = limits[c][1] if high == 1.0 else at[c][ends.index(high)]
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        # values between two brackets count under a number that no value inside has
        gaps = [float("-inf"), *[math.nextafter(b, math.inf) for _, b in spans]]
        x, key = number(c), F.lit(gaps[-1])
        for (a, b), gap in reversed(list(zip(spans, gaps))):
            key = F.when(number(c) < a, F.lit(gap)).when(number(c) <= b, number(c)).otherwise(key)
        keys.append(F.struct(F.lit(c).alias("variable"), F.when(x.isNotNull(), key).alias("value")))
        between[c] = set(gaps)
    counts = (df.select(F.explode(F.array(*keys)).alias("k")).select("k.*").where(F.col("value").isNotNull())
              .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n")))
    cum = running_sums(materialize(counts, "bracketed"), "value", ["n"], ["variable"])
    hit = F.lit(False)
    for c, rs in wanted.items():
        for r in set(rs):
            hit = hit | ((F.col("variable") == c) & (F.col("n_cum") - F.col("n") <= r) & (F.col("n_cum") > r))
    out = {}
    for row in cum.where(hit).collect():  # one row per rank asked for
        for r in set(wanted[row["variable"]]):
            if row["n_cum"] - row["n"] <= r < row["n_cum"] and row["value"] not in between[row["variable"]]:
                out[row["variable"], r] = row["value"]
    return out


def _ptag(p: float) -> str:
    return f"{round(p * 100):02d}"
