"""Cross-validation of all models in shared scans.

A fold's fit is the fit of all rows but the fold's, so folds differ in row
weights only.  Logistic fits take Newton steps: a scan adds up gradient,
Hessian and loss of every (penalty, fold) at once, and the driver solves one
small system each.  Boosted trees share their histogram scans
(``operators/boosting.py``).  One more scan scores every row by the fits that
have not seen it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.blocks import Block, summed
from churnlens.operators.boosting import Trees
from churnlens.operators.metrics import group_auc
from churnlens.session import materialize, ship_package

GRADIENT = 1e-10  # largest gradient entry per unit of weight at which a fit has converged
MAX_STEPS = 100


@dataclass
class Linear:
    """Log-odds = intercept + coefficients . raw features."""

    intercept: float
    coefficients: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.intercept + x @ self.coefficients


@dataclass
class _Problem:
    """One penalised fit: rows outside ``without``, class weights, penalty, the map from common to own standardised features."""

    without: int
    weights: tuple[float, float]
    ridge: np.ndarray
    own: np.ndarray
    beta: np.ndarray
    last: np.ndarray
    loss: float = np.inf
    done: bool = False


def newton_sums(b: Block, problems: list[tuple[int, tuple[float, float], np.ndarray]], mean: np.ndarray,
                scale: np.ndarray) -> np.ndarray:
    """(problems x (1 + p + p * p)): loss, gradient and Hessian over the block, in the common scale."""
    u = np.column_stack([(b.x[:, :-2] - mean) / scale, np.ones(len(b.x))])
    y, fold = b.x[:, -2], b.x[:, -1]
    out = []
    for without, (w0, w1), beta in problems:
        use = fold != without
        v, t = u[use], y[use]
        eta = v @ beta
        w = np.where(t == 1, w1, w0)
        p = 1.0 / (1.0 + np.exp(-eta))
        loss = (w * (np.logaddexp(0.0, eta) - t * eta)).sum()
        out.append(np.concatenate([[loss], v.T @ (w * (p - t)), ((v * (w * p * (1 - p))[:, None]).T @ v).ravel()]))
    return np.stack(out)


def fit_logistic_folds(blocks: RDD, penalties: Mapping[str, float], n_folds: int) -> dict[tuple[str, int], Linear]:
    """(name, fold) -> the balanced logistic fit of the other folds' rows.

    As ``models.fit_logistic`` for each: features standardised by the fit's own
    rows (a constant one counts as 0), C * sum(w * loss) + |b|^2 / 2 with
    balanced class weights, the intercept free.  Blocks hold features, label, fold.
    """
    first = summed(blocks, lambda b: np.concatenate([[len(b.x)], b.x[:, :-2].sum(axis=0)]))
    mean = first[1:] / first[0]

    def by_fold(b: Block) -> np.ndarray:
        out = []
        for f in range(n_folds):
            rows = b.x[b.x[:, -1] == f]
            x = rows[:, :-2] - mean
            out.append(np.concatenate([[len(rows), rows[:, -2].sum()], x.sum(axis=0), (x * x).sum(axis=0)]))
        return np.stack(out)

    facts = summed(blocks, by_fold)
    d = len(mean)
    spread = np.sqrt(np.maximum(facts[:, 2 + d:].sum(axis=0) / first[0] - (facts[:, 2:2 + d].sum(axis=0) / first[0]) ** 2, 0))
    scale = np.where(spread > 0, spread, 1.0)
    problems: dict[tuple[str, int], _Problem] = {}
    for f in range(n_folds):
        n, positive = facts[:, 0].sum() - facts[f, 0], facts[:, 1].sum() - facts[f, 1]
        shift = (facts[:, 2:2 + d].sum(axis=0) - facts[f, 2:2 + d]) / n
        own = np.sqrt(np.maximum((facts[:, 2 + d:].sum(axis=0) - facts[f, 2 + d:]) / n - shift**2, 0))
        varies = own > 1e-12 * np.maximum(spread, 1e-300)
        to_own = np.zeros((d + 1, d + 1))
        to_own[np.arange(d), np.arange(d)] = np.where(varies, scale / np.where(varies, own, 1.0), 0.0)
        to_own[:d, d] = np.where(varies, -shift / np.where(varies, own, 1.0), 0.0)
        to_own[d, d] = 1.0
        weights = (n / (2 * (n - positive)) if n > positive else 1.0, n / (2 * positive) if positive else 1.0)
        for name, c in penalties.items():
            # a constant feature has no gradient: its row needs some curvature
            ridge = np.append(np.where(varies, 1.0 / c, 1.0), 0.0)
            problems[name, f] = _Problem(f, weights, ridge, to_own, np.zeros(d + 1), np.zeros(d + 1))
    for _ in range(MAX_STEPS):
        open_fits = [p for p in problems.values() if not p.done]
        if not open_fits:
            break
        asked = [(p.without, p.weights, p.own.T @ p.beta) for p in open_fits]
        for p, sums in zip(open_fits, summed(blocks, lambda b: newton_sums(b, asked, mean, scale))):
            loss = sums[0] + 0.5 * (p.ridge * p.beta**2).sum()
            if loss > p.loss * (1 + 1e-12) + 1e-12:  # overshot: half the step
                if np.abs(p.beta - p.last).max() < 1e-12:
                    p.done = True
                p.beta = (p.beta + p.last) / 2
                continue
            gradient = p.own @ sums[1:d + 2] + p.ridge * p.beta
            if np.abs(gradient).max() <= GRADIENT * first[0]:
                p.done = True
                continue
            hessian = p.own @ sums[d + 2:].reshape(d + 1, d + 1) @ p.own.T + np.diag(p.ridge)
            p.loss, p.last = loss, p.beta
            p.beta = p.beta - np.linalg.lstsq(hessian, gradient, rcond=1e-14)[0]
    out = {}
    for key, p in problems.items():
        common = p.own.T @ p.beta
        coefficients = common[:-1] / scale
        out[key] = Linear(float(common[-1] - (coefficients * mean).sum()), coefficients)
    return out


def held_out_scores(blocks: DataFrame, fits: Mapping[tuple[str, int], Linear | Trees]) -> DataFrame:
    """(model, fold, label, score) of every row, by each model's fit that left the row's fold out; stored."""
    spark = blocks.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(dict(fits))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = np.frombuffer(raw).reshape(n, -1)
                for (name, fold), fit in shared.value.items():
                    x = rows[rows[:, -1] == fold]
                    p = 1.0 / (1.0 + np.exp(-fit.margin(x[:, :-2])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(x), pa.string()), pa.array(np.full(len(x), fold), pa.int32()),
                         pa.array(x[:, -2].astype(np.int32), pa.int32()), pa.array(p)],
                        names=["model", "fold", "label", "score"])

    rows = blocks.select("n", "x").mapInArrow(score, "model string, fold int, label int, score double")
    return materialize(rows, "fold-scores")


def fold_auc(scores: DataFrame) -> DataFrame:
    """``(model, fold, auc)``: exact area per model and fold; null for a fold that lacks a class."""
    groups = scores.groupBy("model", "fold", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    return group_auc(materialize(groups, "fold-groups"), ["model", "fold"])
