"""k-means for many (k, start) at once: one scan per step serves all of them (M2, M3).

Start centres are chosen by k-means++ (each next row with a probability
proportional to its squared distance to the nearest centre so far), as an
exponential race: the row with the least -log(u) / distance wins, which needs
one scan per centre and no running totals.  Lloyd steps stack the centres of
all unfinished fits into one matrix; a scan assigns every row for every fit and
returns sums and counts per (fit, cluster).  A fit that has converged leaves
the stack, so the scans are those of the longest fit, not the sum over fits.

Random numbers are fixed functions of row id, k and start: a fit gives the same
centres alone or among others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.operators.blocks import Block, reduced, summed, uniform


@dataclass(frozen=True)
class SegmentFit:
    """Centres of one fit; ``inertia`` is the sum of squared distances to them."""

    k: int
    seed: int
    centers: np.ndarray
    inertia: float
    steps: int

    def nearest(self, x: Column) -> Column:
        """The place of the centre nearest to an array column (the first among equals)."""
        far = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)),
                           F.lit(0.0), lambda a, d: a + d) for c in self.centers]
        each = F.array(*far)
        return (F.array_position(each, F.array_min(each)) - 1).cast("int")

    def assign(self, df: DataFrame, features_col: str = "features", out: str = "cluster") -> DataFrame:
        """``df`` with the cluster of every row's feature vector."""
        return df.withColumn(out, self.nearest(vector_to_array(F.col(features_col))))

    def sql(self, columns: Sequence[str]) -> str:
        """The cluster as an SQL expression over one column per feature."""
        far = ["(" + " + ".join(f"(`{n}` - {float(v)!r}D) * (`{n}` - {float(v)!r}D)" for n, v in zip(columns, c)) + ")"
               for c in self.centers]
        each = f"array({', '.join(far)})"
        return f"CAST(array_position({each}, array_min({each})) - 1 AS INT)"


def squared_distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(rows x centres), never below zero; worked out in the place of the result."""
    d = x @ centers.T
    d *= 2.0
    np.subtract((x * x).sum(axis=1)[:, None], d, out=d)
    d += (centers * centers).sum(axis=1)
    return np.maximum(d, 0.0, out=d)


def moments(blocks: RDD) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Number of rows, mean and population variance of each feature; None without a row."""
    first = summed(blocks, lambda b: np.concatenate([[len(b.x)], b.x.sum(axis=0)]))
    if first is None:
        return None
    mean = first[1:] / first[0]
    return int(first[0]), mean, summed(blocks, lambda b: ((b.x - mean) ** 2).sum(axis=0)) / first[0]


def start_centers(blocks: RDD, fits: Sequence[tuple[int, int]], mean: np.ndarray) -> list[np.ndarray]:
    """k-means++ centres (less ``mean``) of each (k, seed)."""
    chosen: list[list[np.ndarray]] = [[] for _ in fits]
    for turn in range(max(k for k, _ in fits)):
        open_fits = [i for i, (k, _) in enumerate(fits) if turn < k]
        so_far = [np.array(chosen[i]) for i in open_fits]

        def race(b: Block):
            x = b.x - mean
            best_key, best_x = np.full(len(open_fits), np.inf), np.zeros((len(open_fits), x.shape[1]))
            for j, i in enumerate(open_fits):
                k, seed = fits[i]
                weight = squared_distances(x, so_far[j]).min(axis=1) if turn else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    key = -np.log(uniform(b.ids, k, seed, turn)) / weight
                at = int(key.argmin())
                best_key[j], best_x[j] = key[at], x[at]
            return best_key, best_x

        def better(a, b):
            first = a[0] <= b[0]
            return np.where(first, a[0], b[0]), np.where(first[:, None], a[1], b[1])

        _, found = reduced(blocks, race, better)
        for j, i in enumerate(open_fits):
            chosen[i].append(found[j])
    return [np.array(c) for c in chosen]


def lloyd_sums(b: Block, mean: np.ndarray, centers: np.ndarray, bounds: Sequence[tuple[int, int]]) -> np.ndarray:
    """(centres x (d + 2)): sum of the rows nearest to a centre within its fit, their number, their squared distances."""
    x = b.x - mean
    far = squared_distances(x, centers)
    member = np.zeros(far.shape)
    least = np.zeros(far.shape[1])
    rows = np.arange(len(x))
    for lo, hi in bounds:
        place = lo + far[:, lo:hi].argmin(axis=1)
        member[rows, place] = 1.0
        least[lo:hi] = np.bincount(place - lo, far[rows, place], hi - lo)
    return np.column_stack([member.T @ x, member.sum(axis=0), least])


def fit_many(blocks: RDD, fits: Sequence[tuple[int, int]], max_iter: int = 300, tol: float = 1e-4) -> list[SegmentFit]:
    """One fit per (k, seed), all in the same scans.

    A fit ends when its centres' summed squared shift is at most ``tol`` times
    the mean variance of the features, or after ``max_iter`` steps.  A centre
    that has lost all rows stays where it is.
    """
    facts = moments(blocks)
    if facts is None:
        raise ValueError("no row to cluster")
    _, mean, variance = facts
    centers = start_centers(blocks, fits, mean)
    limit, steps = tol * float(variance.mean()), [0] * len(fits)
    running = list(range(len(fits)))

    def scan(which: list[int]) -> list[np.ndarray]:
        sizes = np.cumsum([0, *(len(centers[i]) for i in which)])
        bounds, stack = list(zip(sizes[:-1].tolist(), sizes[1:].tolist())), np.concatenate([centers[i] for i in which])
        sums = summed(blocks, lambda b: lloyd_sums(b, mean, stack, bounds))
        return [sums[lo:hi] for lo, hi in bounds]

    for _ in range(max_iter):
        left = []
        for i, sums in zip(running, scan(running)):
            n = sums[:, -2:-1]
            new = np.where(n > 0, sums[:, :-2] / np.maximum(n, 1), centers[i])
            shift = float(((new - centers[i]) ** 2).sum())
            centers[i], steps[i] = new, steps[i] + 1
            if shift > limit:
                left.append(i)
        running = left
        if not running:
            break
    inertia = [float(s[:, -1].sum()) for s in scan(list(range(len(fits))))]
    return [SegmentFit(k, seed, c + mean, w, n) for (k, seed), c, w, n in zip(fits, centers, inertia, steps)]


def best_of(fits: Sequence[SegmentFit]) -> SegmentFit:
    return min(fits, key=lambda f: (f.inertia, f.seed))
