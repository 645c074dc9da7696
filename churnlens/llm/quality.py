"""Quality classifier: random Fourier features, ridge, isotonic calibration.

Each text becomes a vector of document statistics.  Standardised statistics
are mapped to cosines of random projections, whose inner products approximate
a Gaussian kernel.  Ridge regression on the labels needs only the normal
equations, which every partition sums for its rows by fold; leaving one fold's
sums out gives out-of-fold scores, on which pool-adjacent-violators fits the
monotone map from ridge score to probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import read_table, ship_package, stored
from churnlens.llm.labelled import fold_of, labelled_texts

FOLDS = 5
SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = b".!?"
CLIP = 6.0


@dataclass(frozen=True)
class QualityConfig:
    """``max_labelled`` bounds the labelled texts of the fit (expected number)."""

    max_labelled: int = 40_000
    features: int = 256
    seed: int = 7
    bandwidth_sample: int = 500
    ridges: tuple[float, ...] = (0.01, 0.1, 1.0, 10.0)
    threshold: float = 0.5
    partitions: int = 8


def _class_of_bytes() -> dict[str, np.ndarray]:
    b = np.arange(256)
    inside = lambda chars: np.isin(b, np.frombuffer(chars, dtype=np.uint8))
    return {
        "upper": (b >= 65) & (b <= 90), "lower": (b >= 97) & (b <= 122), "digit": (b >= 48) & (b <= 57),
        "space": inside(b" \t\n\r\x0b\x0c"), "line": inside(b"\n"), "symbol": inside(SYMBOLS),
        "end": inside(SENTENCE_ENDS), "comma": inside(b",;:"), "bang": inside(b"!"), "high": b >= 128,
        "bracket": inside(b"()[]{}=\"'/\\_@~^`"),
    }


CLASSES = _class_of_bytes()
CLASS_MATRIX = np.column_stack(list(CLASSES.values())).astype(float)
N_STATS = CLASS_MATRIX.shape[1] + 14


def statistics(text: str | None) -> np.ndarray:
    """The vector of document statistics of a whole text (zeros if empty)."""
    out = np.zeros(N_STATS)
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return out
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n, size = len(words), len(raw)
    share = counts[counts > 0] / size
    k = CLASS_MATRIX.shape[1]
    out[:k] = np.sqrt(counts @ CLASS_MATRIX / size)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    kinds = set(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = np.fromiter((w[-1] for w in words), dtype=np.uint8, count=n)
    out[k:] = (
        math.log1p(n), lengths.mean(), lengths.std(), math.log1p(lengths.max()),
        len(kinds) / n, math.log(len(kinds)) / math.log(n + 1),
        sum(map(eq, words, words[1:])) / n,
        sum(map(eq, words[1:], words[3:])) / n if n > 3 else 0.0,
        -(share * np.log(share)).sum(),
        1 - len(set(lines)) / len(lines), math.log1p(len(lines)), math.log1p(n / len(lines)),
        np.isin(ends, np.frombuffer(SYMBOLS, dtype=np.uint8)).mean(),
        len(set(zip(words, words[1:]))) / n,
    )
    return out


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, projection, ridge weights and the isotonic map."""

    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        return np.column_stack([np.sqrt(2 / len(self.phase)) * np.cos(z @ self.omega + self.phase), np.ones(len(z))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.features(stats) @ self.weights, self.knots, self.values)


def constant_model(share: float) -> QualityModel:
    """Gives every text the same score."""
    return QualityModel(np.zeros(N_STATS), np.ones(N_STATS), np.zeros((N_STATS, 1)), np.zeros(1), np.zeros(2),
                        np.array([0.0, 1.0]), np.array([share, share]))


def pooled(blocks: Iterable[Sequence[float]]) -> list[list[float]]:
    """Adjacent violators pooled: blocks (rows, sum of labels, sum of scores), ascending by score.

    Pooling the parts of a sorted sequence first, then their blocks, gives the blocks of the whole.
    """
    out: list[list[float]] = []
    for block in blocks:
        out.append(list(block))
        while len(out) > 1 and out[-2][1] * out[-1][0] >= out[-1][1] * out[-2][0]:
            last = out.pop()
            out[-1] = [a + b for a, b in zip(out[-1], last)]
    return out


def score_blocks(score: np.ndarray, label: np.ndarray) -> list[list[float]]:
    """Pooled blocks over distinct scores."""
    at, which = np.unique(score, return_inverse=True)
    rows, good = np.bincount(which), np.bincount(which, weights=label)
    return pooled((n, y, n * s) for s, n, y in zip(at.tolist(), rows.tolist(), good.tolist()))


def curve(blocks: Sequence[Sequence[float]], low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Knots and values of pooled blocks whose scores lie between ``low`` and ``high``; knots are the blocks' mean scores.

    Blocks carry one pseudo row of either label, so no probability is 0 or 1.
    """
    knots = np.array([b[2] / b[0] for b in blocks])
    values = np.maximum.accumulate([(b[1] + 0.5) / (b[0] + 1.0) for b in blocks])
    if len(knots) == 1:
        knots, values = np.array([knots[0], knots[0] + 1.0]), np.repeat(values, 2)
    # the ends stretch a little, so that the order of extreme scores is kept
    low, high = low - 1.0, high + 1.0
    return (np.concatenate([[low], knots, [high]]),
            np.concatenate([[values[0] * 0.5], values, [1 - (1 - values[-1]) * 0.5]]))


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over distinct scores."""
    return curve(score_blocks(score, label), score.min(), score.max())


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1,
        cfg: QualityConfig = QualityConfig()) -> QualityModel:
    """Fit on labels whose crc32(doc_id) modulo ``modulus`` is not ``held_out``.

    Without labels of both classes every text gets the share of good labels
    (one half without any).
    """
    spark = docs.sparkSession
    ship_package(spark)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "fold": batch["fold"],
                                "stats": [statistics(t) for t in batch["text"]]})

    texts = labelled_texts(docs, labels, "quality", modulus, held_out, cfg.max_labelled)
    rows = stored(texts.mapInPandas(measure, "label int, fold int, stats array<double>"), "quality-stats")
    ends = rows.agg(F.count("*").alias("n"), F.avg("label").alias("share")).first()
    if not ends.n or ends.share in (0.0, 1.0):
        return constant_model(0.5 if not ends.n else float(ends.share))
    moments = (rows.select(F.posexplode("stats").alias("i", "x")).groupBy("i")
               .agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd")).orderBy("i").toPandas())
    mean, scale = moments["mean"].to_numpy(), np.where(moments["sd"] > 1e-9, moments["sd"], 1.0)
    few = np.stack(rows.select("stats").orderBy(F.xxhash64("stats")).limit(cfg.bandwidth_sample)
                   .toPandas()["stats"].to_numpy())
    z = np.clip((few - mean) / scale, -CLIP, CLIP)
    gaps = np.sqrt(((z[:, None, :] - z[None, :, :]) ** 2).sum(-1))
    width = float(np.median(gaps[gaps > 0])) if (gaps > 0).any() else 1.0
    rng = np.random.default_rng(cfg.seed)
    model = QualityModel(mean, scale, rng.normal(0, 1 / width, (N_STATS, cfg.features)),
                         rng.uniform(0, 2 * np.pi, cfg.features), np.zeros(cfg.features + 1),
                         np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    dims = cfg.features + 1
    shared = spark.sparkContext.broadcast(model)

    def normal_equations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((FOLDS, dims, dims + 1))
        for batch in batches:
            phi = shared.value.features(np.stack(batch["stats"].to_numpy()))
            both = np.column_stack([phi, batch["label"].to_numpy(dtype=float)])
            for f in range(FOLDS):
                at = batch["fold"].to_numpy() == f
                sums[f] += phi[at].T @ both[at]
        for f in range(FOLDS):
            yield pd.DataFrame({"fold": f, "line": range(dims), "sums": list(sums[f])})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": group["fold"][:1], "line": group["line"][:1],
                             "sums": [np.sum(np.stack(group["sums"].to_numpy()), axis=0)]})

    # bounded by max_labelled, so a fixed number of partitions gives the sums
    parts = rows.repartition(cfg.partitions).mapInPandas(normal_equations, "fold int, line int, sums array<double>")
    lines = parts.groupBy("fold", "line").applyInPandas(add, "fold int, line int, sums array<double>").collect()
    sums = np.zeros((FOLDS, dims, dims + 1))
    for r in lines:
        sums[r.fold, r.line] = r.sums
    total = sums.sum(axis=0)

    def solve(s: np.ndarray, ridge: float) -> np.ndarray:
        penalty = ridge * np.eye(dims)
        penalty[-1, -1] = 1e-6
        return np.linalg.solve(s[:, :dims] + penalty, s[:, dims])

    left_out = np.stack([np.stack([solve(total - sums[f], r) for f in range(FOLDS)]) for r in cfg.ridges])
    left_out_of = spark.sparkContext.broadcast(left_out)

    def out_of_fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            phi, fold = shared.value.features(np.stack(batch["stats"].to_numpy())), batch["fold"].to_numpy()
            got = np.einsum("nd,rnd->nr", phi, left_out_of.value[:, fold])
            yield pd.DataFrame({"label": batch["label"], "scores": list(got)})

    tried = rows.mapInPandas(out_of_fold, "label int, scores array<double>").toPandas()  # bounded by max_labelled
    y, scores = tried["label"].to_numpy(dtype=float), np.stack(tried["scores"].to_numpy())
    best = int(((scores - y[:, None]) ** 2).mean(axis=0).argmin())
    knots, values = isotonic(scores[:, best], y)
    return QualityModel(mean, scale, model.omega, model.phase, solve(total, cfg.ridges[best]), knots, values)


def score_udf(spark: SparkSession, model: QualityModel):
    """A vectorised text -> score function (null scores as empty)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            stats = np.stack([statistics(t) for t in batch]) if len(batch) else np.zeros((0, N_STATS))
            yield pd.Series(shared.value.score(stats), dtype=float)

    return score


def keep_good(docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows of ``docs`` that score at or above the threshold, all columns as they came."""
    model = fit(docs, labels, cfg=cfg)
    return docs.where(score_udf(docs.sparkSession, model)(F.col("text")) >= cfg.threshold)


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1,
                    cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null, empty and blank texts have all statistics zero and are scored like
    any other point.  A null doc_id is scored and never held out; repeated
    rows repeat; other columns are ignored; an empty table gives an empty
    result.
    """
    model = fit(docs, labels, modulus, held_out, cfg)
    return docs.select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"),
        score_udf(docs.sparkSession, model)("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= cfg.threshold).cast("int"))


def op5_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of ``documents``."""
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
