"""Mean silhouette with Euclidean distance, over all pairs or against a reference set (M4).

The exact number needs the distance of every pair of rows.  For fits it is
taken so (``silhouette_of_fits``): every block of rows meets every other block
once, the two pass as a stream through a task, and a distance serves all fits.
The work is rows x rows; a task holds two blocks and one sum per row and
cluster, nothing is shuffled, and no row reaches the driver.

Given ``per_cluster``, each cluster is instead represented by its
``per_cluster`` rows of least random order (all of a smaller cluster), and
every row of the table is scored against these: the work is rows x clusters x
``per_cluster``, and only the references travel.  A mean distance to a cluster
becomes the mean over its references, leaving out the row itself, so the result
is exact when the references are everything.

The standard error is a jackknife over ``GROUPS`` groups of references, times
sqrt(1 - share of rows that are references), which is zero for everything.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.blocks import BLOCK_ROWS, Block, reduced, summed, uniform
from churnlens.operators.kmeans import SegmentFit, squared_distances
from churnlens.operators.split import shuffle_key
from churnlens.session import ship_package

GROUPS = 10
PER_CLUSTER = 200
ROWS_AT_ONCE = 512  # whose distances to all references are held at once
TILE = 512, 256  # rows of the one and of the other block whose distances are held at once


@dataclass
class References:
    """Rows that stand for clusters 0 .. n_clusters - 1; ``size`` is each whole cluster's number of rows."""

    x: np.ndarray
    ids: np.ndarray
    cluster: np.ndarray
    size: np.ndarray

    @property
    def group(self) -> np.ndarray:
        return np.arange(len(self.x)) % GROUPS


def silhouettes(x: np.ndarray, ids: np.ndarray, own: np.ndarray, refs: References) -> np.ndarray:
    """(rows x (1 + GROUPS)): each row's silhouette, with all references and without those of one group."""
    parts = [slice(i, i + ROWS_AT_ONCE) for i in range(0, max(len(x), 1), ROWS_AT_ONCE)]
    return np.concatenate([_silhouettes(x[p], ids[p], own[p], refs) for p in parts])


def _silhouettes(x: np.ndarray, ids: np.ndarray, own: np.ndarray, refs: References) -> np.ndarray:
    k, n = len(refs.size), len(x)
    far = squared_distances(x, refs.x)
    np.sqrt(far, out=far)
    itself = ids[:, None] == refs.ids
    far[itself] = 0.0
    slot = refs.cluster * GROUPS + refs.group
    to_slot = np.zeros((len(slot), k * GROUPS))
    to_slot[np.arange(len(slot)), slot] = 1.0
    sums = (far @ to_slot).reshape(n, k, GROUPS)
    counts = to_slot.sum(axis=0).reshape(1, k, GROUPS) - (itself @ to_slot).reshape(n, k, GROUPS)
    out = np.empty((n, 1 + GROUPS))
    for g in range(-1, GROUPS):
        s, c = sums.sum(axis=2), counts.sum(axis=2)
        if g >= 0:
            s, c = s - sums[:, :, g], c - counts[:, :, g]
        out[:, 1 + g] = _values(s, c, own, refs.size)
    return out


def _values(sums: np.ndarray, counts: np.ndarray, own: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Silhouettes from each row's summed distances to the clusters, and to how many rows these are."""
    rows = np.arange(len(own))
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(counts > 0, sums / counts, np.inf)
    a = mean[rows, own].copy()
    mean[rows, own] = np.inf
    b = mean.min(axis=1)
    known = (size[own] > 1) & np.isfinite(a) & np.isfinite(b)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = (b - a) / np.maximum(a, b)
    return np.where(known & (np.maximum(a, b) > 0), value, 0.0)


def summary(total: np.ndarray, rows: int, share: float) -> tuple[float, float]:
    """(mean silhouette, standard error) from the sums over all rows."""
    means = total / rows
    parts = means[1:]
    error = np.sqrt(max(0.0, 1.0 - share) * (GROUPS - 1) / GROUPS * ((parts - parts.mean()) ** 2).sum())
    return float(means[0]), float(error)


def nearest_of_fits(x: np.ndarray, fits: Sequence[SegmentFit]) -> np.ndarray:
    """(fits x rows): each row's cluster in every fit."""
    return np.stack([squared_distances(x, f.centers).argmin(axis=1) for f in fits])


def add_distances(out: np.ndarray, x: np.ndarray, y: np.ndarray, own: np.ndarray, starts: Sequence[int],
                  same: bool) -> None:
    """Adds each ``x`` row's distances to the rows of ``y``, summed by cluster, to ``out`` (clusters x rows of x).

    ``own`` (fits x rows of y) are the clusters of ``y``; those of a fit begin
    at its place in ``starts``.  Rows of ``y`` alike in all fits are summed
    first.  With ``same`` the two are one block, and a row is 0 from itself.
    """
    high, wide = TILE
    order = np.lexsort(own)
    left = np.column_stack([-2.0 * y, np.ones(len(y)), (y * y).sum(axis=1)])[order]
    right = np.ascontiguousarray(np.column_stack([x, (x * x).sum(axis=1), np.ones(len(x))]).T)
    for i in range(0, len(y), high):
        part = order[i:i + high]
        kinds = own[:, part]
        cuts = [0, *(np.flatnonzero((kinds[:, 1:] != kinds[:, :-1]).any(axis=0)) + 1).tolist(), len(part)]
        runs = list(zip(cuts[:-1], cuts[1:]))
        to = np.zeros((len(out), len(runs)))
        for start, clusters in zip(starts, kinds[:, cuts[:-1]]):
            to[start + clusters, np.arange(len(runs))] = 1.0
        for j in range(0, len(x), wide):
            far = left[i:i + high] @ right[:, j:j + wide]
            np.abs(far, out=far)  # below zero by rounding only
            np.sqrt(far, out=far)
            if same:
                here = np.flatnonzero((part >= j) & (part < j + wide))
                far[here, part[here] - j] = 0.0
            by_run = np.empty((len(runs), far.shape[1]))
            for r, (lo, hi) in enumerate(runs):
                np.add.reduce(far[lo:hi], axis=0, out=by_run[r])
            out[:, j:j + wide] += to @ by_run


def joined(found: Iterator[Block]) -> Iterator[Block]:
    """Small blocks put together, up to ``BLOCK_ROWS`` rows."""
    held: list[Block] = []

    def block() -> Block:
        return Block(np.concatenate([b.x for b in held]), np.concatenate([b.ids for b in held]))

    for b in found:
        if held and sum(len(h.x) for h in held) + len(b.x) > BLOCK_ROWS:
            yield block()
            held = []
        held.append(b)
    if held:
        yield block()


def exact_silhouettes(blocks: RDD, fits: Sequence[SegmentFit]) -> list[float]:
    """Mean silhouette of each fit over all pairs of rows: one scan for the sizes, one over all pairs of blocks."""
    starts = np.cumsum([0, *(f.k for f in fits)]).tolist()

    def count(b: Block) -> np.ndarray:
        return np.concatenate([*(np.bincount(own, minlength=f.k) for own, f in zip(nearest_of_fits(b.x, fits), fits)), [1]])

    *size, number = summed(blocks, count)
    size = np.array(size)
    rows, origin = int(size[:fits[0].k].sum()), fits[0].centers.mean(axis=0)  # near the rows, to keep digits

    def score(pairs: Iterator[tuple[Block, Block]]) -> Iterator[np.ndarray]:
        met: dict[int, list] = {}  # blocks that have not met all rows yet: one, or the few of a batch
        for a, b in pairs:
            first = int(a.ids[0])
            if first not in met:
                met[first] = [np.zeros((starts[-1], len(a.x))), 0]
            state = met[first]
            add_distances(state[0], a.x - origin, b.x - origin, nearest_of_fits(b.x, fits), starts, first == b.ids[0])
            state[1] += len(b.x)
            if state[1] == rows:
                yield scores(a, met.pop(first)[0])

    def scores(a: Block, sums: np.ndarray) -> np.ndarray:
        out, at = [], np.arange(len(a.x))
        for own, lo, hi in zip(nearest_of_fits(a.x, fits), starts[:-1], starts[1:]):
            counts = np.tile(size[lo:hi], (len(a.x), 1))
            counts[at, own] -= 1
            out.append(_values(sums[lo:hi].T, counts, own, size[lo:hi]).sum())
        return np.array(out)

    tasks = max(blocks.context.defaultParallelism, math.ceil(rows / BLOCK_ROWS))
    small = number > 2 * tasks  # every pair of blocks is a step, however few rows they have
    met_by = blocks.coalesce(tasks).mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK) if small else blocks
    try:
        # the second side is one partition, read from the blocks where they are kept: a task sees all of it, block by block
        found = met_by.cartesian(met_by.coalesce(1)).mapPartitions(score)
        return [float(t) / rows for t in summed(found, lambda t: t)]
    finally:
        if small:
            met_by.unpersist()


def silhouette_of_fits(blocks: RDD, fits: Sequence[SegmentFit], per_cluster: int | None = None,
                       seed: int = 42) -> list[tuple[float, float]]:
    """(mean silhouette, standard error) of each fit, from all pairs of rows: the error is 0.

    With ``per_cluster`` every row is scored against that many references of a
    cluster instead: one scan chooses them, one scores all rows.
    """
    if per_cluster is None:
        return [(mean, 0.0) for mean in exact_silhouettes(blocks, fits)]

    def draw(b: Block):
        order, out = uniform(b.ids, seed), []
        for f in fits:
            own = squared_distances(b.x, f.centers).argmin(axis=1)
            size = np.bincount(own, minlength=f.k)
            rows = []
            for c in range(f.k):
                mine = np.flatnonzero(own == c)
                mine = mine[np.argsort(order[mine], kind="stable")[:per_cluster]]
                rows.append((order[mine], b.ids[mine], b.x[mine]))
            out.append((size, rows))
        return out

    def merge(a, b):
        out = []
        for (n, p), (m, q) in zip(a, b):
            rows = []
            for u, v in zip(p, q):
                both = [np.concatenate(z) for z in zip(u, v)]
                first = np.lexsort((both[1], both[0]))[:per_cluster]
                rows.append(tuple(z[first] for z in both))
            out.append((n + m, rows))
        return out

    refs = [References(np.concatenate([r[2] for r in rows]), np.concatenate([r[1] for r in rows]),
                       np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows]), size)
            for size, rows in reduced(blocks, draw, merge)]
    shared = blocks.context.broadcast(refs)  # at most fits x k x per_cluster rows

    def score(b: Block) -> np.ndarray:
        return np.stack([silhouettes(b.x, b.ids, squared_distances(b.x, f.centers).argmin(axis=1), r).sum(axis=0)
                         for f, r in zip(fits, shared.value)])

    return [summary(t, int(r.size.sum()), len(r.x) / r.size.sum()) for t, r in zip(summed(blocks, score), refs)]


def euclidean_silhouette(df: DataFrame, key: str, cluster: str, features: str, per_cluster: int = PER_CLUSTER,
                         seed: int = 42) -> DataFrame:
    """One row (n, n_references, silhouette, standard_error) for given clusters.

    ``features`` is an array column.  A cluster's references are its rows of
    least (md5 of key and seed, key); rows with a null cluster are left out;
    a cluster of one row scores 0.  Keys should be unique.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = df.where(F.col(cluster).isNotNull()).select(
        F.col(key).alias("key"), F.col(cluster).alias("cluster"), F.col(features).cast("array<double>").alias("x"))
    sizes = {r["cluster"]: r["n"] for r in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = {c: i for i, c in enumerate(sorted(sizes))}
    first = Window.partitionBy("cluster").orderBy(shuffle_key("key", seed), "key")
    found = (rows.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= per_cluster)
             .orderBy("cluster", "_at").collect())  # at most clusters x per_cluster rows
    if not found:
        return spark.createDataFrame([(0, 0, None, None)], "n long, n_references long, silhouette double, standard_error double")
    numbers = {r["key"]: i for i, r in enumerate(found)}
    refs = References(np.array([r["x"] for r in found]), np.arange(len(found)),
                      np.array([place[r["cluster"]] for r in found]), np.array([sizes[c] for c in sorted(sizes)]))
    shared = spark.sparkContext.broadcast((refs, numbers, place))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs, numbers, place = shared.value
        total, n = np.zeros(1 + GROUPS), 0
        for batch in batches:
            ids = np.array([numbers.get(k, -1) for k in batch.column(0).to_pylist()])
            own = np.array([place[c] for c in batch.column(1).to_pylist()])
            x = batch.column(2).flatten().to_numpy().reshape(len(ids), -1)
            total, n = total + silhouettes(x, ids, own, refs).sum(axis=0), n + len(ids)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array(range(1), pa.int32()), pa.array([total])],
                                         names=["n", "one", "total"])

    parts = rows.mapInArrow(score, "n long, one int, total array<double>")
    sums = parts.select("n", F.posexplode("total").alias("i", "t")).groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("t").alias("t")).orderBy("i").collect()
    mean, error = summary(np.array([r["t"] for r in sums]), sums[0]["n"], len(found) / sums[0]["n"])
    return spark.createDataFrame([(sums[0]["n"], len(found), mean, error)],
                                 "n long, n_references long, silhouette double, standard_error double")
