"""Toxic passages by maximum-scoring segments over token log-odds.

Lexicon: every word and its leading stems are nodes; a node's count in a
class is the number of distinct contexts (previous word, word) in labelled
texts, so copies count once.  Log-odds between the classes carry a Dirichlet
prior of the pooled counts; a node stands out if its counts are far from the
pooled share (signed root of the likelihood ratio).  Below such a node, longer stems and words have counts of
their own, shrunk towards their stem's rate (again a Dirichlet prior), and a
token takes its most specific known node.

Scan: a token scores log(1 - r + r * odds), where r is the share of toxic
words in a toxic passage, so ordinary tokens score a little below zero.  One
linear pass finds all maximal-scoring segments of a whole text.

Calibration: scores of chance segments follow an extreme-value law with
decay lambda (from the token scores of clean texts) and scale K (censored
maximum likelihood over clean texts).  The sums of a text's best segments, of
all that raise the sum, become one log p-value, and an isotonic curve over it gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.bpe_count import GenerationCache
from churnlens.llm.common import read_table, ship_package, stored
from churnlens.llm.labelled import fold_of, labelled_texts
from churnlens.llm.quality import isotonic

STEMS = (4, 5, 6, 7, 8)
END = "$"
BIN = 0.05
CACHE_ENTRIES = 150_000
RUNS = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class ToxicityConfig:
    """Parameters of the fit.

    ``max_labelled`` bounds the labelled texts (their expected number), and
    with them the lexicon; ``prior`` is the Dirichlet mass spread over the
    pooled frequencies, as a share of the toxic counts, on top of one half per
    node.  A passage is significant if chance gives at most ``max_expected``
    such segments in a text of its length.
    """

    max_labelled: int = 20_000
    max_expected: float = 0.05
    prior: float = 0.001
    min_contexts: int = 4
    min_z: float = 6.0
    min_log_odds: float = 1.0
    stem_prior: float = 4.0
    toxic_share: float = 0.05
    threshold: float = 0.3


@dataclass(frozen=True)
class ToxicityModel:
    """Node log-odds, the extreme-value constants and the isotonic score curve."""

    nodes: dict[str, float] = field(default_factory=dict)
    toxic_share: float = 0.05
    decay: float = 1.0
    scale: float = 1.0
    knots: tuple[float, ...] = (0.0, 1.0)
    values: tuple[float, ...] = (0.0, 0.0)

    def token_score(self, piece: str) -> float:
        """Score of one whitespace-separated piece: its best word's."""
        best = 0.0
        for word in RUNS.findall(piece.lower()):
            best = max(best, next((self.nodes[n] for n in reversed(nodes_of(word)) if n in self.nodes), 0.0))
        r = self.toxic_share
        return math.log(1 - r + r * math.exp(best)) if best else math.log(1 - r)

    def log_p(self, scores: list[float], n: int) -> float:
        """Minus the log p-value of a text's best segments (sum statistics).

        Segments count, best first, as long as the sum grows: one that chance
        gives once or more in a text of this length adds nothing.
        """
        best, total = 0.0, 0.0
        floor = math.log(max(self.scale * max(n, 1), 1.0))
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            gain = self.decay * s - floor
            if gain <= 0:
                break
            total += gain
            best = max(best, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r))
        return best

    def expected(self, score: float, n: int) -> float:
        """How many segments of at least this score chance gives in a text of ``n`` tokens."""
        return self.scale * n * math.exp(-self.decay * score)

    def score(self, scores: list[float], n: int) -> float:
        return float(np.interp(math.log1p(self.log_p(scores, n)), self.knots, self.values))


def nodes_of(word: str) -> list[str]:
    """The stems of a word and the word itself."""
    return [word[:k] for k in STEMS if len(word) > k] + [word + END]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) in linear time.

    Candidates are kept with the total before and after them and a link to the
    nearest earlier candidate that starts lower, so each is passed once.
    """
    total = np.cumsum(scores)
    found: list[tuple[int, int, float, float, int]] = []  # start, end, before, after, earlier
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, after = i, i + 1, float(total[i])
        before = after - float(scores[i])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = found[j][4]
            if j < 0 or found[j][3] >= after:
                found.append((start, end, before, after, j))
                break
            start, before = found[j][0], found[j][2]
            del found[j:]
    return [(s, e, after - before) for s, e, before, after, _ in found]


class Scanner:
    """Applies a model to texts; piece scores are cached per worker task."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self.scores = GenerationCache(model.token_score, entries=CACHE_ENTRIES)

    def __call__(self, text: str | None) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
        pieces = (text or "").split()
        tokens = np.fromiter(map(self.scores.__getitem__, pieces), dtype=float, count=len(pieces))
        return tokens, segments(tokens)


def _lexicon(texts: DataFrame, cfg: ToxicityConfig) -> dict[str, float]:
    """Log-odds of the nodes that stand out and of those below them (collected: words of the labelled sample)."""
    words = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")
    pairs = F.transform(F.sequence(F.lit(2), F.size("w")), lambda i: F.struct(
        F.element_at("w", i).alias("word"), F.xxhash64(F.element_at("w", i - 1)).alias("before")))
    contexts = (texts.select("label", F.concat(F.array(F.lit("")), F.filter(words, lambda w: w != "")).alias("w"))
                .where(F.size("w") > 1).select("label", F.explode(pairs).alias("p"))
                .select("label", "p.word", "p.before").distinct()
                .groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")))
    contexts = contexts.select("t", "c", "word")
    chain = F.array(*[F.when(F.length("word") > k, F.substring("word", 1, k)) for k in STEMS],
                    F.concat("word", F.lit(END)))
    nodes = (contexts.select("t", "c", F.explode(chain).alias("node")).where("node is not null")
             .groupBy("node").agg(F.sum("t").alias("t"), F.sum("c").alias("c")))
    nodes = stored(nodes.where(F.col("t") + F.col("c") >= cfg.min_contexts), "toxicity-nodes")
    ends = contexts.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    n_t, n_c = float(ends.t or 0), float(ends.c or 0)
    if not n_t or not n_c:
        return {}
    mass = cfg.prior * n_t
    alpha = 0.5 + mass * (F.col("t") + F.col("c")) / (n_t + n_c)

    def log_odds(y, n):
        return F.log((y + alpha) / (n + mass + 1 - y - alpha))

    def surprise(y, n):
        return F.when(y > 0, y * F.log(y * (n_t + n_c) / ((F.col("t") + F.col("c")) * n))).otherwise(0.0)

    error = F.sqrt(1 / (F.col("t") + alpha) + 1 / (F.col("c") + alpha))
    root = F.sqrt(F.greatest(2 * (surprise(F.col("t"), n_t) + surprise(F.col("c"), n_c)), F.lit(0.0)))
    out = (nodes.select("node", (log_odds(F.col("t"), n_t) - log_odds(F.col("c"), n_c)).alias("d"), error.alias("e"),
                        root.alias("z"), "t")
           .where(F.col("t") >= cfg.min_contexts).where(F.col("z") >= cfg.min_z)
           .where(F.col("d") - F.col("e") >= cfg.min_log_odds))
    top = {r.node: r.d - r.e for r in out.collect()}
    base = math.log(n_t / n_c)
    tops = texts.sparkSession.createDataFrame([(n,) for n in top if not n.endswith(END)], "stem string")
    stems = F.array(*[F.when(F.length("node") > k, F.substring("node", 1, k)) for k in STEMS])
    below = (nodes.select("node", "t", "c", F.explode(stems).alias("stem")).join(tops, "stem")
             .select("node", "t", "c").distinct())
    rates: dict[str, float] = {}
    for r in sorted(below.collect(), key=lambda r: (r.node.endswith(END), len(r.node))):
        parent = next(p for p in reversed(nodes_of(r.node.removesuffix(END))[:-1] + [r.node[:-1]])
                      if p != r.node and (p in rates or p in top))
        rate = rates.get(parent, 1 / (1 + math.exp(-top.get(parent, 0.0) - base)))
        rates[r.node] = (r.t + cfg.stem_prior * rate) / (r.t + r.c + cfg.stem_prior)
    return top | {n: math.log(m / (1 - m)) - base for n, m in rates.items()}


def _decay(bins: dict[int, int], tokens: int, background: float) -> float:
    """The lambda > 0 at which clean tokens' mean of exp(lambda * score) is one."""
    plain = tokens - sum(bins.values())

    def excess(x):
        return (plain * math.exp(x * background) + sum(c * math.exp(x * b * BIN) for b, c in bins.items())) / tokens - 1

    if not bins or not plain:
        return 1.0
    low, high = 1e-3, 1.0
    while excess(high) < 0 and high < 16:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2,
        cfg: ToxicityConfig = ToxicityConfig()) -> ToxicityModel:
    """Fit on labels whose crc32(doc_id) modulo ``modulus`` is not ``held_out``.

    Without labels of both classes the model gives every text the share of
    toxic labels (0 without any).
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = stored(labelled_texts(docs, labels, "toxic", modulus, held_out, cfg.max_labelled), "toxicity-labelled")
    nodes = _lexicon(texts, cfg)
    model = ToxicityModel(nodes, cfg.toxic_share)
    scan_of = spark.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = Scanner(scan_of.value)
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["label"]):
                tokens, found = run(text)
                best = sorted((s for *_, s in found), reverse=True)
                rows.append((int(label), len(tokens), best,
                             np.rint(tokens[tokens > 0] / BIN).astype(int).tolist() if not label else []))
            yield pd.DataFrame(rows, columns=["label", "n", "best", "bins"])

    scanned = stored(texts.mapInPandas(scan, "label int, n long, best array<double>, bins array<int>"), "toxicity-scan")
    bins = {r.bin: r["count"] for r in scanned.select(F.explode("bins").alias("bin")).groupBy("bin").count().collect()}
    sample = scanned.select("label", "n", "best").toPandas()  # bounded by max_labelled
    clean, y = sample[sample.label == 0], sample.label.to_numpy(dtype=float)
    if not len(clean) or len(clean) == len(sample) or not nodes:
        share = float(y.mean()) if len(y) else 0.0
        return ToxicityModel(toxic_share=cfg.toxic_share, values=(share, share))
    decay = _decay(bins, int(clean.n.sum()), math.log(1 - cfg.toxic_share))
    top = np.array([max(b, default=0.0) for b in clean.best])
    scale = max(1, (top > 0).sum()) / max(1e-9, float((clean.n.to_numpy() * np.exp(-decay * top)).sum()))
    model = ToxicityModel(nodes, cfg.toxic_share, decay, scale)
    x = np.array([math.log1p(model.log_p(list(b), n)) for b, n in zip(sample.best, sample.n)])
    knots, values = isotonic(x, y)
    return ToxicityModel(nodes, cfg.toxic_share, decay, scale, tuple(knots.tolist()), tuple(values.tolist()))


def score_udf(spark: SparkSession, model: ToxicityModel, max_expected: float = ToxicityConfig.max_expected):
    """A vectorised text -> (score, n_passages) function (null scores as empty)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("score double, n_passages long")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        run, m = Scanner(shared.value), shared.value
        for batch in texts:
            out = []
            for text in batch:
                tokens, found = run(text)
                sums = [s for *_, s in found]
                out.append((m.score(sums, len(tokens)), sum(m.expected(s, len(tokens)) <= max_expected for s in sums)))
            yield pd.DataFrame(out, columns=["score", "n_passages"]).astype({"score": float, "n_passages": "int64"})

    return score


def passages(docs: DataFrame, model: ToxicityModel, max_expected: float = ToxicityConfig.max_expected) -> DataFrame:
    """doc_id, first_word, end_word, score, expected: every significant passage.

    ``expected`` is the number of such segments chance gives in a text of this
    length; word positions count whitespace-separated pieces.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, m = Scanner(shared.value), shared.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                tokens, found = run(text)
                for first, end, s in found:
                    expected = m.expected(s, len(tokens))
                    if expected <= max_expected:
                        rows.append((doc_id, first, end, s, expected))
            out = pd.DataFrame(rows, columns=["doc_id", "first_word", "end_word", "score", "expected"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(
        find, "doc_id long, first_word long, end_word long, score double, expected double")


def keep_clean(docs: DataFrame, labels: DataFrame, cfg: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns as they came."""
    model = fit(docs, labels, cfg=cfg)
    return docs.where(score_udf(docs.sparkSession, model)(F.col("text"))["score"] < cfg.threshold)


def score_documents(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2,
                    cfg: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """doc_id, held_out, score, n_passages (significant ones), predicted of every row.

    Null and empty texts have no segment and get the curve's lowest score.
    A null doc_id is scored and never held out; repeated rows repeat; other
    columns are ignored; an empty table gives an empty result.
    """
    model = fit(docs, labels, modulus, held_out, cfg)
    return docs.select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"),
        score_udf(docs.sparkSession, model, cfg.max_expected)("text").alias("found"),
    ).select("doc_id", "held_out", "found.score", "found.n_passages",
             (F.col("found.score") >= cfg.threshold).cast("int").alias("predicted"))


def op3_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    return score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
