"""Second-order gradient-boosted trees by histogram sums.

Chen & Guestrin, "XGBoost: A Scalable Tree Boosting System" (arXiv:1603.02754).
Features are cut at quantiles once.  Every level of a tree is one scan: a block
adds up gradients and hessians of the logistic loss per (fit, node, feature,
bin), the sums meet by tree, and the driver picks each node's best split

    GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)

from them.  A leaf is worth -step * G / (H + l2).  Rows are sampled per tree by
a fixed function of their id in the stored blocks, columns by the round, and
gradients are summed as integers (fixed point): which task reads a block, and
in which order sums meet, changes nothing.

Several fits, as the folds of a cross-validation, share every scan: a fit is
all rows but those of one fold.  Margins live with the blocks in the executors
and are advanced by each finished tree; every ``CHECKPOINT`` trees the state is
written to the shared checkpoint folder, which bounds what a lost executor costs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators import treeshap
from churnlens.operators.blocks import Block, loaded, stored_blocks, summed, uniform
from churnlens.schema import GBTConfig
from churnlens.session import ship_package

CHECKPOINT = 25
NO_FOLD = -1
LEAST_GAIN = 1e-6


@dataclass
class Trees:
    """The trees of one fit as heaps: children of node i are 2i + 1 and 2i + 2, a row goes left if x <= threshold."""

    feature: np.ndarray     # (trees x nodes), -1 for a leaf or an unused place
    threshold: np.ndarray
    value: np.ndarray       # of a leaf
    cover: np.ndarray       # sum of hessians of the rows that reached the node

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x`` (rows x features)."""
        rows, out = np.arange(len(x)), np.zeros(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            while (inner := feature[node] >= 0).any():
                right = x[rows, np.maximum(feature[node], 0)] > threshold[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += value[node]
        return out

    def for_shap(self) -> list[treeshap.Tree]:
        place = np.arange(self.feature.shape[1])
        return [treeshap.Tree(np.where(f >= 0, 2 * place + 1, -1), np.where(f >= 0, 2 * place + 2, -1), f, t, v, c)
                for f, t, v, c in zip(self.feature.astype(np.int64), self.threshold, self.value, self.cover)]


@dataclass
class Binning:
    """Cuts of every feature (a row's bin is the number of cuts below its value) and where its bins start."""

    cuts: list[np.ndarray]

    @property
    def bins(self) -> np.ndarray:
        return np.array([len(c) + 1 for c in self.cuts])

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.bins) - self.bins

    @property
    def total(self) -> int:
        return int(self.bins.sum())


def fit_bins(df: DataFrame, names: Sequence[str], bins: int) -> Binning:
    """Quantile cuts by mergeable sketches, one aggregation for all features.

    A feature of few values keeps each of them; no cut stands at the maximum.
    """
    shares = F.expr("array(" + ", ".join(f"{i / bins!r}D" for i in range(1, bins)) + ")")
    row = df.agg(*[F.percentile_approx(F.col(f"`{n}`").cast("double"), shares, 20 * bins).alias(f"q{i}")
                   for i, n in enumerate(names)],
                 *[F.max(F.col(f"`{n}`").cast("double")).alias(f"m{i}") for i, n in enumerate(names)]).first()
    cuts = [np.unique(np.array(row[f"q{i}"] or [], dtype=float)) for i in range(len(names))]
    return Binning([c[c < (row[f"m{i}"] if row[f"m{i}"] is not None else -np.inf)] for i, c in enumerate(cuts)])


@dataclass
class State:
    """A block in training: bins (features x rows), label, fold, ids, margins (fits x rows)."""

    codes: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    ids: np.ndarray
    margin: np.ndarray


@dataclass(frozen=True)
class Fit:
    """All rows but those of fold ``without``; ``weight`` is that of a positive row."""

    without: int
    weight: float


def initial(block: Block, binning: Binning, fits: int) -> State:
    """Columns of the block are the features, then label and fold."""
    d = len(binning.cuts)
    kind = np.uint8 if binning.bins.max(initial=1) <= 256 else np.uint16
    codes = np.stack([np.searchsorted(c, block.x[:, j]).astype(kind) for j, c in enumerate(binning.cuts)])
    return State(codes, block.x[:, d].copy(), block.x[:, d + 1].astype(np.int64), block.ids, np.zeros((fits, len(block.x))))


def descend(codes: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The heap place of every row after ``levels`` levels of one tree; rows stay in leaves."""
    rows = np.arange(codes.shape[1])
    node = np.zeros(codes.shape[1], dtype=np.int64)
    for _ in range(levels):
        f = feature[node]
        right = codes[np.maximum(f, 0), rows] > cut[node]
        node = np.where(f >= 0, 2 * node + 1 + right, node)
    return node


def level_sums(state: State, fits: Sequence[Fit], binning: Binning, columns: np.ndarray, feature: np.ndarray,
               cut: np.ndarray, level: int, turn: int, share: float, seed: int, scale: float) -> np.ndarray:
    """(fits x nodes of the level x bins of all features x 2) integer sums of gradients and hessians."""
    nodes, first = 1 << level, binning.first
    out = np.zeros((len(fits), nodes, binning.total, 2), dtype=np.int64)
    drawn = uniform(state.ids, seed, turn) < share
    for f, fit in enumerate(fits):
        node = descend(state.codes, feature[f], cut[f], level) - (nodes - 1)
        use = np.flatnonzero(drawn & (state.fold != fit.without) & (node >= 0))
        if not len(use):
            continue
        p = 1.0 / (1.0 + np.exp(-state.margin[f, use]))
        y = state.label[use]
        w = np.where(y == 1, fit.weight, 1.0) * scale
        g, h = np.rint(w * (p - y)), np.rint(w * p * (1.0 - p))
        base = node[use]
        for j in columns:
            n = int(binning.bins[j])
            key = base * n + state.codes[j, use]
            span = slice(first[j], first[j] + n)
            out[f, :, span, 0] = np.bincount(key, g, nodes * n).reshape(nodes, n)
            out[f, :, span, 1] = np.bincount(key, h, nodes * n).reshape(nodes, n)
    return out


def advanced(state: State, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, depth: int) -> State:
    """The state with one finished tree per fit added to the margins."""
    step = np.stack([v[descend(state.codes, f, c, depth)] for f, c, v in zip(feature, cut, value)])
    return State(state.codes, state.label, state.fold, state.ids, state.margin + step)


def best_splits(sums: np.ndarray, binning: Binning, columns: np.ndarray, cfg: GBTConfig):
    """For each row of ``sums`` (nodes x bins x 2): gain, feature, cut and the left child's G and H of the best split."""
    first, last = binning.first, binning.first + binning.bins - 1
    upto = np.cumsum(sums, axis=1)
    owner = np.repeat(np.arange(len(first)), binning.bins)
    before = np.where(first > 0, first - 1, 0)
    left = upto - np.where((first > 0)[None, :, None], upto[:, before], 0)[:, owner]
    j = int(columns[0])
    total = left[:, last[j]][:, None]
    right = total - left
    score = lambda s: s[..., 0] ** 2 / (s[..., 1] + cfg.l2)
    gain = score(left) + score(right) - score(total)
    allowed = np.isin(owner, columns)
    allowed[last] = False
    fits = allowed & (left[..., 1] >= cfg.min_child_weight) & (right[..., 1] >= cfg.min_child_weight)
    gain = np.where(fits, gain, -np.inf)
    at = gain.argmax(axis=1)
    rows = np.arange(len(sums))
    return gain[rows, at], owner[at], at - first[owner[at]], left[rows, at], total[:, 0]


def columns_of(turn: int, d: int, cfg: GBTConfig) -> np.ndarray:
    """The features that a round's trees may use."""
    n = max(1, int(cfg.column_share * d))
    return np.sort(np.random.default_rng([cfg.seed, turn]).permutation(d)[:n])


def train(blocks: RDD, binning: Binning, fits: Sequence[Fit], rows: int, cfg: GBTConfig = GBTConfig()) -> list[Trees]:
    """The trees of every fit; ``cfg.max_depth`` scans a round serve all of them."""
    d, nodes = len(binning.cuts), (1 << (cfg.max_depth + 1)) - 1
    # fixed point: as fine as sums of all rows allow within 2**62
    scale = 2.0 ** min(30, 61 - math.ceil(math.log2(max(rows, 1) * max(1.0, *(f.weight for f in fits)) + 1)))
    shape = (cfg.max_iter, len(fits), nodes)
    feature, cut = np.full(shape, -1, dtype=np.int32), np.zeros(shape, dtype=np.int32)
    value, cover = np.zeros(shape), np.zeros(shape)
    state = blocks.map(lambda b: initial(b, binning, len(fits))).persist(StorageLevel.MEMORY_AND_DISK)
    held = [state]
    for turn in range(cfg.max_iter):
        columns = columns_of(turn, d, cfg)
        feat, cuts, val, cov = feature[turn], cut[turn], value[turn], cover[turn]
        for level in range(cfg.max_depth):
            gain, which, at, left, total = summed(
                state, lambda s: level_sums(s, fits, binning, columns, feat, cuts, level, turn, cfg.subsampling_rate, cfg.seed, scale),
                lambda sums: best_splits(sums.reshape(-1, *sums.shape[2:]) / scale, binning, columns, cfg))
            for old in held[:-1]:  # the scan has stored the newest state
                old.unpersist()
            held = held[-1:]
            here = (1 << level) - 1
            grown = False
            for i in range(len(gain)):
                f, node = divmod(i, 1 << level)
                node += here
                if level and feat[f, (node - 1) // 2] < 0:
                    continue
                cov[f, node] = total[i, 1]
                val[f, node] = -cfg.step_size * total[i, 0] / (total[i, 1] + cfg.l2)
                if gain[i] > max(LEAST_GAIN, cfg.min_gain):
                    grown = True
                    feat[f, node], cuts[f, node] = which[i], at[i]
                    for child, s in ((2 * node + 1, left[i]), (2 * node + 2, total[i] - left[i])):
                        cov[f, child] = s[1]
                        val[f, child] = -cfg.step_size * s[0] / (s[1] + cfg.l2)
            if not grown:
                break
        if turn + 1 < cfg.max_iter:
            state = state.map(lambda s: advanced(s, feat, cuts, val, cfg.max_depth)).persist(StorageLevel.MEMORY_AND_DISK)
            if (turn + 1) % CHECKPOINT == 0:
                state.checkpoint()
            held.append(state)
    for old in held:
        old.unpersist()
    threshold = np.zeros(shape)
    for j, c in enumerate(binning.cuts):
        if len(c):
            threshold = np.where(feature == j, c[np.minimum(cut, len(c) - 1)], threshold)
    value = np.where(feature >= 0, 0.0, value)
    return [Trees(feature[:, f], threshold[:, f], value[:, f], cover[:, f]) for f in range(len(fits))]


TREE_COLUMNS = "tree int, node int, feature int, threshold double, value double, cover double"


@dataclass
class BoostedModel:
    """Fitted trees with the encoding of their features; scores like :class:`models.ChurnModel`."""

    pipeline: PipelineModel
    names: tuple[str, ...]
    label: str
    trees: Trees
    kind: str = "boosted"
    margin_scale: float = 1.0  # the leaves add up to the log-odds

    def margin(self, encoded: DataFrame):
        """A Column with the log-odds over the encoded feature columns."""
        spark = encoded.sparkSession
        ship_package(spark)
        shared = spark.sparkContext.broadcast(self.trees)

        @F.pandas_udf("double")
        def margin(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            trees = shared.value
            for batch in batches:
                yield pd.Series(trees.margin(np.column_stack([c.to_numpy(dtype=float) for c in batch])))

        return margin(*[F.col(f"`{n}`").cast("double") for n in self.names])

    def score(self, df: DataFrame, prob: str = "prob", prediction: str = "prediction") -> DataFrame:
        """Class at 0.5 and P(churn)."""
        encoded = self.pipeline.transform(df)
        scored = encoded.withColumn("_margin", self.margin(encoded))
        return scored.select(*df.columns, (1.0 / (1.0 + F.exp(-F.col("_margin")))).alias(prob),
                             (F.col("_margin") > 0).cast("int").alias(prediction))

    def save(self, path: str) -> None:
        t = self.trees
        rows = pd.DataFrame({"tree": np.repeat(np.arange(len(t.feature)), t.feature.shape[1]),
                             "node": np.tile(np.arange(t.feature.shape[1]), len(t.feature)),
                             "feature": t.feature.ravel(), "threshold": t.threshold.ravel(), "value": t.value.ravel(),
                             "cover": t.cover.ravel()})
        self.pipeline.write().overwrite().save(f"{path}/encoding")
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(rows, TREE_COLUMNS).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, path: str, names: Sequence[str], label: str) -> BoostedModel:
        rows = SparkSession.getActiveSession().read.parquet(f"{path}/trees").orderBy("tree", "node").toPandas()
        shape = (rows["tree"].nunique(), -1)
        trees = Trees(*[rows[c].to_numpy().reshape(shape) for c in ("feature", "threshold", "value", "cover")])
        return cls(PipelineModel.load(f"{path}/encoding"), tuple(names), label, trees)


def training_blocks(encoded: DataFrame, names: Sequence[str], label: str, fold: str | None = None) -> DataFrame:
    """Stored blocks of the features, then label and fold, of every row."""
    return stored_blocks(encoded, F.array(*[F.col(f"`{n}`").cast("double") for n in names], F.col(label).cast("double"),
                                          (F.col(fold) if fold else F.lit(NO_FOLD)).cast("double")), "training")


def fit_trees(blocks: RDD, binning: Binning, n_folds: int, cfg: GBTConfig = GBTConfig()) -> list[Trees]:
    """Trees of all rows, then of the rows without fold 0, 1, ..., in the same scans.

    A positive row weighs negatives / positives of its fit's rows (1 if a class is missing).
    """
    counts = summed(blocks, lambda b: np.array([[((b.x[:, -1] != f) & (b.x[:, -2] == y)).sum() for y in (0, 1)]
                                                for f in (NO_FOLD - 1, *range(n_folds))]))
    if counts is None:
        raise ValueError("no row to fit")
    fits = [Fit(f, float(n0 / n1) if n0 and n1 else 1.0) for f, (n0, n1) in zip((NO_FOLD - 1, *range(n_folds)), counts)]
    return train(blocks, binning, fits, int(counts[0].sum()), cfg)


def fit_boosted(train_rows: DataFrame, pipeline: PipelineModel, names: Sequence[str], label: str,
                cfg: GBTConfig = GBTConfig(), fold: str | None = None, n_folds: int = 0) -> list[BoostedModel]:
    """The model of all rows, then one per fold left out (column ``fold``, 0 .. n_folds - 1).

    Quantile cuts are those of all rows.  Null features are refused.
    """
    encoded = pipeline.transform(train_rows)
    blocks = loaded(training_blocks(encoded, names, label, fold))
    try:
        found = fit_trees(blocks, fit_bins(encoded, names, cfg.bins), n_folds, cfg)
    finally:
        blocks.unpersist()
    return [BoostedModel(pipeline, tuple(names), label, t) for t in found]
