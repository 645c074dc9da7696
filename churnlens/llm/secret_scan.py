"""Secret scans: fixed patterns, and a character convolutional network over every candidate.

Three fixed patterns give the base findings.  Candidates are all maximal runs
of at least twelve characters a secret may hold; every base finding touches
one.  A network in numpy reads a candidate with its surrounding text and gives
one probability per kind of finding.  It is trained on all candidates, labelled
by the base findings: shards of them take Adam steps side by side and their
states are averaged after every turn.  It is calibrated on a fold left out of
training, and reports a candidate that no pattern found if a kind's probability
reaches the largest threshold that still finds the wanted share of that fold's
findings.

The texts are read once: one map keeps base findings and candidates with their
surroundings, a table far smaller than the texts, and training and scoring read
that.  A candidate of any length is read whole: it is cut into pieces that
overlap by the reach of the convolutions, so pooled pieces equal the pooled whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import numbered, read_table, ship_package, stored
from churnlens.llm.quality import curve, pooled, score_blocks
from churnlens.operators.blocks import summed

# The kinds of base findings with their patterns and least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex")
ADDED = "net"
# A text without any of these, lower-cased, has no assignment.
KEYS = (b"passw", b"secret", b"token", b"key")

LEAST = 12  # characters of a candidate
LEFT, RIGHT = 24, 8  # characters around a candidate that the network sees
IN_RUN = np.zeros(256, dtype=bool)
IN_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True

PIECE, HALO = 64, 4  # outputs of a piece, and inputs beyond it on either side (two convolutions of width 5)
CODES = 100  # 0 padding, 1-95 printable, 96 white space, 97 control, 98 beyond ASCII, 99 spare
TEXT_BYTES = 16_000_000  # texts scanned at once (a longer text goes alone)
WINDOWS_AT_ONCE = 2_000
RANGE_ROWS = 200_000  # sorted logits that one task pools


@dataclass(frozen=True)
class SecretConfig:
    """``recall`` of each kind is that on the left-out fold.

    A candidate of a class of more than ``full_weight`` weighs ``full_weight``
    / size; rare ones are shown more often instead, up to ``repeats`` times
    an epoch.  A shard takes about ``turn_rows`` candidates a
    turn, ``turns`` times an epoch.  Every candidate is shown ``epochs`` times,
    or less often, but at least once, where that is more than ``visits`` in all.
    """

    full_weight: int = 3_000
    repeats: int = 16
    turn_rows: int = 1_024
    turns: int = 16
    visits: int = 24_000
    recall: float = 0.98
    embedding: int = 8
    filters: int = 16
    epochs: int = 8
    batch: int = 64
    rate: float = 0.004
    seed: int = 13


# --- candidates ------------------------------------------------------------------------------------------------------

def base_findings(text: str, runs: Sequence[tuple[int, int]], keyed: bool) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start, then kind.

    Access keys and hexadecimal numbers lie inside a run of at least twelve
    characters, so only ``runs`` are searched for them.
    """
    found = []
    if keyed:
        found += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    for a, b in runs:
        run = text[a:b]
        for kind, pattern, least in ((1, ACCESS, ACCESS_LEAST), (2, HEX, HEX_LEAST)):
            if b - a >= least:
                found += [(kind, a + m.start(), a + m.end()) for m in pattern.finditer(run) if len(m[0]) >= least]
    return sorted(found, key=lambda f: (f[1], f[0], f[2]))


def scan(raws: Sequence[bytes]) -> list[tuple[list[tuple], list[tuple]]]:
    """Per UTF-8 text: base findings (kind, start, end) and candidates (start, end, at, window, label).

    Places are code points.  ``window`` is the candidate with its
    surroundings, ``at`` its place there, ``label`` has bit k set if a finding
    of kind k overlaps it.
    """
    out: list[tuple[list, list]] = [([], []) for _ in raws]
    joined = np.frombuffer(b"\n".join([*raws, b""]), dtype=np.uint8)
    edge = np.diff(np.concatenate([[False], IN_RUN[joined], [False]]).astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = stop - start >= LEAST
    start, stop = start[long], stop[long]
    ends = np.cumsum([len(r) + 1 for r in raws])
    owner = np.searchsorted(ends, start, side="right")
    for i in np.unique(owner).tolist():
        raw, mine = raws[i], owner == i if len(raws) == 1 else slice(*np.searchsorted(owner, [i, i + 1]))
        a, b = start[mine] - (ends[i] - len(raw) - 1), stop[mine] - (ends[i] - len(raw) - 1)
        text = raw.decode()
        if len(text) < len(raw):  # bytes to code points
            before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)])
            a, b = before[a], before[b]
        runs = list(zip(a.tolist(), b.tolist()))
        low = raw.lower()
        found = base_findings(text, runs, any(k in low for k in KEYS))
        labels, first = [0] * len(runs), 0
        for kind, s, e in found:  # runs are disjoint and ascending, findings ascend by start
            while first < len(runs) and runs[first][1] <= s:
                first += 1
            j = first
            while j < len(runs) and runs[j][0] < e:
                labels[j] |= 1 << kind
                j += 1
        out[i] = (found, [(s, e, min(s, LEFT), text[max(0, s - LEFT):e + RIGHT], y) for (s, e), y in zip(runs, labels)])
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (kind, start, end) and seen (start, end, at, window, label) of every row of ``docs``."""
    ship_package(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()
    base = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    seen = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("at", pa.int32()),
                               ("window", pa.string()), ("label", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = [r or b"" for r in batch.column(1).cast(pa.large_binary()).to_pylist()]
            found, first, size = [], 0, 0
            for i, r in enumerate(raws):
                size += len(r)
                if size >= TEXT_BYTES or i + 1 == len(raws):
                    found += scan(raws[first:i + 1])
                    first, size = i + 1, 0
            bases = [[dict(zip(("kind", "start", "end"), f)) for f in b] for b, _ in found]
            others = [[dict(zip(("start", "end", "at", "window", "label"), c)) for c in s] for _, s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, base), pa.array(others, seen)],
                                             names=["doc_id", "base", "seen"])

    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {key}, base array<struct<kind:int,start:long,end:long>>, "
              "seen array<struct<start:long,end:long,at:int,window:string,label:int>>")


# --- network ---------------------------------------------------------------------------------------------------------

def _code_table() -> np.ndarray:
    table = np.full(129, 97, dtype=np.uint8)
    table[32:127] = np.arange(1, 96)
    table[[9, 10, 11, 12, 13]] = 96
    table[128] = 98
    return table


CODE_OF = _code_table()


@dataclass
class Pieces:
    """Windows cut into pieces: rows of codes with their masks; ``first`` is each window's first row."""

    codes: np.ndarray
    inside: np.ndarray
    valid: np.ndarray
    first: np.ndarray
    length: np.ndarray

    @property
    def window(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first)), np.diff([*self.first, len(self.codes)]))


def codes_of(windows: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all windows one after the other, and their lengths."""
    points = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return CODE_OF[np.minimum(points, 128)], np.array([len(w) for w in windows], dtype=np.int64)


def pieces(codes: np.ndarray, sizes: np.ndarray, at: np.ndarray, length: np.ndarray) -> Pieces:
    """Cut windows (one after the other in ``codes``) whose candidate starts at ``at`` and has ``length`` characters."""
    count = np.maximum(-(-sizes // PIECE), 1)
    first = np.cumsum(count) - count
    window = np.repeat(np.arange(len(sizes)), count)
    offset = (np.arange(len(window)) - first[window]) * PIECE
    place = offset[:, None] + np.arange(-HALO, PIECE + HALO)  # place inside the window
    known = (place >= 0) & (place < sizes[window][:, None])
    begin = (np.cumsum(sizes) - sizes)[window][:, None]
    flat = np.concatenate([codes, np.zeros(1, dtype=np.uint8)])
    rows = flat[np.where(known, begin + place, len(codes))]
    inside = (place >= at[window][:, None]) & (place < (at + length)[window][:, None])
    return Pieces(rows, inside, known[:, HALO:-HALO], first, length)


@dataclass
class Network:
    """Embedding, two convolutions of width 5, pooling (maximum; mean over the candidate), one logit per kind."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, cfg: SecretConfig) -> Network:
        rng, e, f = np.random.default_rng(cfg.seed), cfg.embedding, cfg.filters
        normal = lambda fan, *shape: (rng.normal(size=shape) * np.sqrt(2 / fan)).astype(np.float32)
        return cls({"embed": normal(e, CODES, e), "w1": normal(5 * (e + 1), 5, e + 1, f), "b1": np.zeros(f, np.float32),
                    "w2": normal(5 * f, 5, f, f), "b2": np.zeros(f, np.float32),
                    "out": normal(2 * f, 2 * f, len(KINDS)), "bias": np.zeros(len(KINDS), np.float32)})

    def forward(self, p: Pieces) -> tuple[np.ndarray, tuple]:
        """Logits of each window, and what the backward pass needs."""
        w = self.weights
        x = np.concatenate([w["embed"][p.codes], p.inside[..., None].astype(w["embed"].dtype)], axis=-1)
        wide = PIECE + HALO
        h1 = sum(x[:, k:k + wide] @ w["w1"][k] for k in range(5)) + w["b1"]
        np.maximum(h1, 0, out=h1)
        h2 = sum(h1[:, k:k + PIECE] @ w["w2"][k] for k in range(5)) + w["b2"]
        np.maximum(h2, 0, out=h2)
        h2 *= p.valid[..., None]
        top = np.maximum.reduceat(h2.max(axis=1), p.first)
        share = (p.inside[:, HALO:-HALO] & p.valid) / np.maximum(p.length, 1)[p.window][:, None]
        share = share.astype(h2.dtype)
        mean = np.add.reduceat(np.einsum("rt,rtf->rf", share, h2), p.first)
        pooled = np.concatenate([top, mean], axis=1)
        return pooled @ w["out"] + w["bias"], (x, h1, h2, top, share, pooled)

    def gradients(self, p: Pieces, labels: np.ndarray, weight: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy over windows (times their weights) and kinds."""
        w = self.weights
        logits, (x, h1, h2, top, share, pooled) = self.forward(p)
        d = (1 / (1 + np.exp(-logits)) - labels) / labels.size
        if weight is not None:
            d = d * weight[:, None]
        d = d.astype(x.dtype)
        grad = {"out": pooled.T @ d, "bias": d.sum(axis=0)}
        d = (d @ w["out"].T)[p.window]
        f = top.shape[1]
        best = h2 == top[p.window][:, None]  # equal maxima share the gradient
        ties = np.add.reduceat(best.sum(axis=1), p.first)[p.window].astype(x.dtype)
        d2 = best * (d[:, :f] / ties)[:, None] + share[..., None] * d[:, None, f:]
        d2 *= h2 > 0
        grad["w2"] = np.stack([np.tensordot(h1[:, k:k + PIECE], d2, ([0, 1], [0, 1])) for k in range(5)])
        grad["b2"] = d2.sum(axis=(0, 1))
        d1 = np.zeros_like(h1)
        for k in range(5):
            d1[:, k:k + PIECE] += d2 @ w["w2"][k].T
        d1 *= h1 > 0
        wide = PIECE + HALO
        grad["w1"] = np.stack([np.tensordot(x[:, k:k + wide], d1, ([0, 1], [0, 1])) for k in range(5)])
        grad["b1"] = d1.sum(axis=(0, 1))
        dx = np.zeros_like(x)
        for k in range(5):
            dx[:, k:k + wide] += d1 @ w["w1"][k].T
        grad["embed"] = np.stack([np.bincount(p.codes.ravel(), dx[..., e].ravel(), CODES)
                                  for e in range(x.shape[-1] - 1)], axis=1).astype(x.dtype)
        return grad


@dataclass
class State:
    """A network in training with Adam's moments and number of steps."""

    net: Network
    mean: dict[str, np.ndarray]
    square: dict[str, np.ndarray]
    step: float = 0

    @classmethod
    def fresh(cls, cfg: SecretConfig) -> State:
        net = Network.fresh(cfg)
        return cls(net, *[{k: np.zeros_like(v) for k, v in net.weights.items()} for _ in range(2)])

    def numbers(self) -> np.ndarray:
        return np.concatenate([*[v.ravel() for d in (self.net.weights, self.mean, self.square) for v in d.values()],
                               [self.step]]).astype(float)

    def like(self, numbers: np.ndarray) -> State:
        """A state of the same shapes from its numbers."""
        dicts, first = [], 0
        for d in (self.net.weights, self.mean, self.square):
            dicts.append({})
            for k, v in d.items():
                dicts[-1][k] = numbers[first:first + v.size].reshape(v.shape).astype(v.dtype)
                first += v.size
        return State(Network(dicts[0]), *dicts[1:], numbers[-1])


@dataclass
class Share:
    """Distinct labelled windows that a shard reads in one turn."""

    shard: int
    turn: int
    codes: np.ndarray   # of all windows, one after the other
    sizes: np.ndarray
    at: np.ndarray
    length: np.ndarray
    label: np.ndarray


def train(state: State, share: Share, weights: dict[int, float], cfg: SecretConfig, epochs: int, seed) -> State:
    """Adam over the share's candidates, each weighted by its label's weight.

    Findings are also shown in altered form, so that neither key word nor
    letter case alone decides: with the surroundings of another candidate, and
    with the case of their letters turned.
    """
    rng, net = np.random.default_rng(seed), Network(dict(state.net.weights))
    mean, square = ({k: v.copy() for k, v in d.items()} for d in (state.mean, state.square))
    codes, at, length = np.split(share.codes, np.cumsum(share.sizes)[:-1]), share.at, share.length
    labels = ((share.label[:, None] >> np.arange(len(KINDS))) & 1).astype(np.float32)
    weight = np.array([weights[y] for y in share.label.tolist()])
    times = np.clip(np.rint(weight / min(weights.values())), 1, cfg.repeats).astype(np.int64)
    shown, weight = np.repeat(np.arange(len(codes)), times), (weight / times).astype(np.float32)
    small, large = np.arange(66, 92), np.arange(34, 60)  # codes of a-z and A-Z
    turn = np.arange(CODES, dtype=np.uint8)
    turn[small], turn[large] = large, small
    n, step = len(codes), state.step
    for _ in range(epochs):
        order = shown[rng.permutation(len(shown))]
        for first in range(0, len(order), cfg.batch):
            pick = order[first:first + cfg.batch]
            some, places = [], at[pick].copy()
            for j, i in enumerate(pick):
                c, a, m = codes[i], at[i], length[i]
                if labels[i].any() and rng.random() < 0.5:
                    core = turn[c[a:a + m]] if rng.random() < 0.5 else c[a:a + m]
                    o = rng.integers(n)
                    c = np.concatenate([codes[o][:at[o]], core, codes[o][at[o] + length[o]:]])
                    places[j] = at[o]
                some.append(c)
            p = pieces(np.concatenate(some), np.array([len(c) for c in some]), places, length[pick])
            step += 1
            for k, g in net.gradients(p, labels[pick], weight[pick]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                net.weights[k] = net.weights[k] - cfg.rate * (mean[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
    return State(net, mean, square, step)


def shares(windows: DataFrame, shards: int, turns: int) -> RDD:
    """Every row of ``windows`` dealt by hash to one :class:`Share`; a partition holds one shard."""
    def read(row) -> Share:
        codes, sizes = codes_of([w.window for w in row.windows])
        return Share(row.shard, row.turn, codes, sizes, *[np.array([w[c] for w in row.windows], dtype=np.int64)
                                                          for c in ("at", "length", "label")])

    place = lambda name, n: F.pmod(F.xxhash64(F.lit(name), "hash"), F.lit(n)).cast("int").alias(name)
    rows = windows.groupBy(place("shard", shards), place("turn", turns)).agg(
        F.array_sort(F.collect_list(F.struct("hash", "at", "length", "label", "window"))).alias("windows"))
    return rows.rdd.map(lambda r: (r.shard, read(r))).partitionBy(shards, lambda shard: shard).values()


def train_all(windows: DataFrame, sizes: dict[int, int], cfg: SecretConfig) -> Network:
    """The network trained on every row of ``windows`` (hash, at, length, label, window); ``sizes`` are its rows by label.

    In a turn every shard starts from the same state and passes over its
    share; the mean of the states, by rows, is the next turn's.  A single shard
    has no other to meet, so its epochs are one turn.
    """
    n = sum(sizes.values())
    weights = {y: min(1.0, cfg.full_weight / m) for y, m in sizes.items()}
    low = min(weights.values())
    often = {y: min(max(round(w / low), 1), cfg.repeats) for y, w in weights.items()}
    mean = sum(weights[y] * m for y, m in sizes.items()) / sum(often[y] * m for y, m in sizes.items())
    weights = {y: w / mean for y, w in weights.items()}
    epochs = min(cfg.epochs, math.ceil(cfg.visits / n))
    shards = math.ceil(n / (cfg.turn_rows * cfg.turns))
    turns, alone = (cfg.turns, 1) if shards > 1 else (1, epochs)
    data = shares(windows, shards, turns).persist(StorageLevel.MEMORY_AND_DISK)
    state = State.fresh(cfg)
    for turn in range(epochs * turns // alone):
        def pass_over(share: Share) -> np.ndarray | None:
            if share.turn != turn % turns:
                return None
            seed = [cfg.seed, turn, share.shard] if shards > 1 else cfg.seed
            numbers = train(state, share, weights, cfg, alone, seed).numbers()
            return np.append(numbers, 1.0) * len(share.sizes)

        total = summed(data, pass_over)
        if total is not None:
            state = state.like(total[:-1] / total[-1])
    data.unpersist()
    return state.net


@dataclass
class SecretModel:
    """A network with, for each kind, a calibration curve and a threshold (infinite: the kind was never seen)."""

    net: Network
    curves: list[tuple[np.ndarray, np.ndarray]]
    thresholds: np.ndarray

    def probabilities(self, windows: Sequence[str], at: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.zeros((len(windows), len(KINDS)))
        for first in range(0, len(windows), WINDOWS_AT_ONCE):
            some = slice(first, first + WINDOWS_AT_ONCE)
            codes, sizes = codes_of(windows[some])
            logits = self.net.forward(pieces(codes, sizes, at[some], length[some]))[0]
            for k, (knots, values) in enumerate(self.curves):
                out[some, k] = np.interp(logits[:, k], knots, values)
        return out

    def accepted(self, probabilities: np.ndarray) -> np.ndarray:
        return (probabilities >= self.thresholds).any(axis=1)


def left_out_logits(windows: DataFrame, net: Network) -> DataFrame:
    """(kind, logit, y) of every row of ``windows``, stored."""
    shared = windows.sparkSession.sparkContext.broadcast(net)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, length, label = (batch.column(i).to_numpy().astype(np.int64) for i in range(3))
            texts = batch.column(3).to_pylist()
            for first in range(0, len(texts), WINDOWS_AT_ONCE):
                some = slice(first, first + WINDOWS_AT_ONCE)
                logits = shared.value.forward(pieces(*codes_of(texts[some]), at[some], length[some]))[0].astype(float)
                kind = np.tile(np.arange(len(KINDS), dtype=np.int32), len(logits))
                y = (np.repeat(label[some], len(KINDS)) >> kind) & 1
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(logits.ravel()), pa.array(y.astype(np.int32))],
                                                 names=["kind", "logit", "y"])

    return stored(windows.select("at", "length", "label", "window").mapInArrow(work, "kind int, logit double, y int"),
                  "secret-logits")


def curves(logits: DataFrame, rows: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """kind -> its isotonic curve: ranges of the sorted logits are pooled in tasks, their few blocks here."""
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # one of the ranges
        if not held:
            return
        kind, logit, y = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3))
        for k in np.unique(kind).tolist():
            mine = kind == k
            blocks = np.array(score_blocks(logit[mine], y[mine]))
            ends = [np.full(len(blocks), v) for v in (logit[mine].min(), logit[mine].max())]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(blocks), k, np.int32)), *[pa.array(c) for c in ends],
                                              *[pa.array(c) for c in blocks.T]], names=["kind", "low", "high", "n", "y", "total"])

    ranges = logits.repartitionByRange(math.ceil(rows / RANGE_ROWS), "kind", "logit")
    blocks = ranges.mapInArrow(pool, "kind int, low double, high double, n double, y double, total double").collect()
    out = {}
    for k in {r.kind for r in blocks}:
        mine = sorted((r for r in blocks if r.kind == k), key=lambda r: (r.low, r.total / r.n))
        out[k] = curve(pooled([r.n, r.y, r.total] for r in mine), mine[0].low, mine[-1].high)
    return out


def fit(seen: DataFrame, cfg: SecretConfig = SecretConfig()) -> SecretModel | None:
    """The model for a stored table of :func:`candidates`; None if no finding or nothing but findings is labelled.

    Equal windows are used once.  Every fifth by a hash is left out of
    training, calibrates and sets the thresholds; if these lack findings or
    other candidates, all train and all calibrate.
    """
    rows = seen.select(F.explode("seen").alias("c")).select("c.at", "c.window", "c.label", (F.col("c.end") - F.col("c.start")).alias("length"))
    rows = rows.withColumn("hash", F.xxhash64("window", "at"))
    windows = stored(rows.groupBy("hash", "at", "length", "label").agg(F.first("window").alias("window"))
                     .withColumn("held", F.pmod(F.xxhash64(F.lit("fold"), "hash"), F.lit(5)) == 0), "secret-windows")
    sizes: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for r in windows.groupBy("held", "label").agg(F.count("*").alias("n")).collect():  # at most 8 combinations of kinds
        sizes[r.held][r.label] = r.n
    every = {y: sizes[True].get(y, 0) + sizes[False].get(y, 0) for y in {*sizes[True], *sizes[False]}}
    if not any(every) or not every.get(0):
        return None
    training, held = windows.where("not held"), windows.where("held")
    if not sizes[False] or not any(sizes[True]) or 0 not in sizes[True]:  # too few to leave any out
        training, held, sizes = windows, windows, {True: every, False: every}
    net = train_all(training, sizes[False], cfg)
    model = SecretModel(net, [(np.array([0.0, 1.0]), np.zeros(2))] * len(KINDS), np.full(len(KINDS), np.inf))
    logits, n = left_out_logits(held, net), sum(sizes[True].values())
    found = {k: sum(m for y, m in sizes[True].items() if y >> k & 1) for k in range(len(KINDS))}
    kinds = [k for k, m in found.items() if 0 < m < n]
    shapes = curves(logits.where(F.col("kind").isin(kinds)), n * len(kinds))
    wanted = {k: int((1 - cfg.recall) * found[k]) for k in kinds}
    ranked = numbered(logits.where("y = 1").select("kind", "logit"), ["kind"], ["logit"], "rank", "secret-ranks")
    at = F.create_map(*[F.lit(v) for item in wanted.items() for v in item])
    for r in ranked.where(F.col("rank") == at[F.col("kind")]).collect():  # one per kind
        model.curves[r.kind] = shapes[r.kind]
        model.thresholds[r.kind] = float(np.interp(r.logit, *shapes[r.kind]))
    return model


# --- operator --------------------------------------------------------------------------------------------------------

def find_secrets(docs: DataFrame, cfg: SecretConfig = SecretConfig()) -> DataFrame:
    """doc_id, findings (kind, start, end, probability) of every row, by start, then kind.

    Kinds are ``assign``, ``access``, ``hex`` (by pattern; probability null)
    and ``net`` (candidates of at least twelve characters that overlap no such
    finding and that the network accepts).  Places are code points, the end
    exclusive.  A null or empty text has no finding; repeated rows and null
    ids are rows like any other; extra columns are ignored; an empty table
    gives an empty result; without any labelled finding nothing is added.
    """
    spark = docs.sparkSession
    seen = stored(candidates(docs), "secret-candidates")
    shared = spark.sparkContext.broadcast(fit(seen, cfg))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = batch.column(2).to_pylist()
            extra: list[list[dict]] = [[] for _ in rows]
            todo = [(i, c) for i, cs in enumerate(rows) for c in cs or () if not c["label"]]
            if model is not None and todo:
                distinct = list({(c["window"], c["at"], c["end"] - c["start"]) for _, c in todo})
                got = model.probabilities([d[0] for d in distinct], np.array([d[1] for d in distinct]),
                                          np.array([d[2] for d in distinct]))
                best = dict(zip(distinct, zip(model.accepted(got).tolist(), got.max(axis=1).tolist())))
                for i, c in todo:
                    yes, probability = best[c["window"], c["at"], c["end"] - c["start"]]
                    if yes:
                        extra[i].append({"start": c["start"], "end": c["end"], "probability": probability})
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(extra, kind)],
                                             names=["doc_id", "base", "extra"])

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = seen.mapInArrow(add, f"doc_id {key}, base array<struct<kind:int,start:long,end:long>>, "
                                "extra array<struct<start:long,end:long,probability:double>>")
    names = "array(" + ", ".join(f"'{k}'" for k in (*KINDS, ADDED)) + ")"
    both = F.expr(f"transform(array_sort(concat("
                  f"transform(base, b -> struct(b.start as start, b.kind as kind, b.end as end, double(null) as probability)),"
                  f"transform(extra, e -> struct(e.start as start, {len(KINDS)} as kind, e.end as end, e.probability as probability))"
                  f")), f -> struct({names}[f.kind] as kind, f.start as start, f.end as end, f.probability as probability))")
    return rows.select("doc_id", both.alias("findings"))


def listed(findings: str) -> Column:
    """kind:start:end of an array of findings, comma-joined."""
    return F.expr(f"array_join(transform({findings}, f -> concat(f.kind, ':', f.start, ':', f.end)), ',')")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    rows = find_secrets(read_table(spark, sf_dir, "documents"))
    rows = rows.withColumn("base", F.expr(f"filter(findings, f -> f.kind <> '{ADDED}')"))
    counts = [F.expr(f"size(filter(base, f -> f.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"),
                       listed("findings").alias("spans"))
