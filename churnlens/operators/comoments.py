"""Co-moments of many columns in one scan, and what follows from them.

For every pair of columns the rows that have both count: their number, sums,
squares and product.  A batch gives all pairs by a few matrix products; tasks
add up their batches, and the sums of all tasks meet per pair, so 200 columns
are one scan and one aggregation by pair.  Values are taken relative to a value
near each column's middle, which keeps the sums exact enough and makes a
constant column's variance exactly zero.  The stored table adds: Pearson's r,
covariances and principal components need no further pass, and tables of
further rows with the same centres can be added up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.session import materialize, ship_package

SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def comoments(df: DataFrame, columns: Sequence[str], centers: Sequence[float] | None = None) -> DataFrame:
    """Stored ``(i, j, x, y, cx, cy, n, sx, sy, sxx, syy, sxy)`` for every pair i <= j of columns.

    Sums run over the rows with a value (no null, no NaN) in both columns, of
    the values less the columns' centres ``cx``, ``cy``.
    """
    columns = list(columns)
    ship_package(df.sparkSession)
    number = [F.col(f"`{c}`").cast("double") for c in columns]
    number = [F.when(~F.isnan(x), x).alias(f"x{i}") for i, x in enumerate(number)]
    rows = df.select(*number)
    if centers is None:
        middle = rows.agg(*[F.percentile_approx(f"x{i}", 0.5, 100).alias(f"m{i}") for i in range(len(columns))]).first()
        centers = [0.0 if m is None else float(m) for m in middle]
    center = np.array(centers, dtype=float)
    d = len(columns)
    at, to = np.triu_indices(d)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), d, d))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - center
            known = ~np.isnan(x)
            x, k = np.where(known, x, 0.0), known.astype(float)
            square, cross, n = (x * x).T @ k, x.T @ x, k.T @ k
            one = x.T @ k  # [i, j]: sum of column i over the rows with both
            total += np.stack([n, one, one.T, square, square.T, cross])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(to.astype(np.int32)), *[pa.array(t[at, to]) for t in total]],
            names=["i", "j", *SUMS])

    parts = rows.mapInArrow(sums, "i int, j int, " + ", ".join(f"{s} double" for s in SUMS))
    return materialize(_named(parts.groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS]), columns, center), "comoments")


def _named(sums: DataFrame, columns: Sequence[str], center: np.ndarray) -> DataFrame:
    names, middle = F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(float(c)) for c in center])
    return sums.select("i", "j", names[F.col("i")].alias("x"), names[F.col("j")].alias("y"),
                       middle[F.col("i")].alias("cx"), middle[F.col("j")].alias("cy"),
                       F.col("n").cast("long").alias("n"), *SUMS[1:])


def added(*tables: DataFrame) -> DataFrame:
    """One stored table for the rows of several with the same columns and centres."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return materialize(rows.groupBy("i", "j", "x", "y", "cx", "cy").agg(*[F.sum(s).alias(s) for s in SUMS]), "comoments")


def _spread(s: str, ss: str):
    n = F.col("n")
    return F.col(ss) - F.col(s) * F.col(s) / n


def covariances(table: DataFrame) -> DataFrame:
    """``(x, y, n, covariance)``, the sample covariance of every pair i <= j; null with fewer than two rows."""
    c = F.col("sxy") - F.col("sx") * F.col("sy") / F.nullif(F.col("n"), F.lit(0))
    return table.select("x", "y", "n", (c / F.nullif(F.col("n") - 1, F.lit(0))).alias("covariance"))


def pearson(table: DataFrame) -> DataFrame:
    """``(x, y, r)`` for all ordered pairs, itself included; null if either column does not vary over the pair's rows."""
    some = table.where("n > 0")
    c = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    a, b = _spread("sx", "sxx"), _spread("sy", "syy")
    r = F.when((a > 0) & (b > 0), c / F.sqrt(a) / F.sqrt(b))
    rows = some.select("i", "j", "x", "y", r.alias("r")).unionByName(
        table.where("n = 0").select("i", "j", "x", "y", F.lit(None).cast("double").alias("r")))
    other = F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "r")
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("x", "y", "r"))).otherwise(F.array(F.struct("x", "y", "r"), other))
    return rows.select(F.explode(both).alias("p")).select("p.x", "p.y", "p.r")


def components(table: DataFrame, k: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, loadings d x k, shares of the variance) of the principal components, from the table alone.

    The largest absolute loading of a component is positive.  Columns x columns
    numbers reach the driver.
    """
    rows = table.collect()
    d = 1 + max(r["j"] for r in rows)
    cov, mean = np.zeros((d, d)), np.zeros(d)
    for r in rows:
        c = (r["sxy"] - r["sx"] * r["sy"] / r["n"]) / (r["n"] - 1)
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = c
        if r["i"] == r["j"]:
            mean[r["i"]] = r["cx"] + r["sx"] / r["n"]
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:k]
    loadings = vectors[:, order]
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(len(order))])
    return mean, loadings * np.where(signs == 0, 1.0, signs), values[order] / max(values.sum(), 1e-300)
