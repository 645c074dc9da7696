"""Periodic runs of words, found by block convolution.

A run is a longest stretch of consecutive words that repeats with smallest
period q and is at least max(12, 2q) words long.  At every dyadic scale B the
text is cut into aligned blocks of B words.  A run of period q in
[2B - 1, 4B - 2] holds an aligned block inside its first q words, and the same
block again q words later.  Those places are the zeros of

    sum_j (x[s + j] - x[s + q + j])^2 = sum b^2 + sum w^2 - 2 sum_j b[j] w[q + j]

over the window of the 2B distances of the scale; the last sum is a correlation
of block and window, formed for many blocks at once by a number-theoretic
transform modulo a prime (small blocks: term by term).  Modular arithmetic is
exact, so no zero is missed; a sum that is only a multiple of the prime fails
the comparison of words that extends every distance to both sides.

Only blocks whose words all lie in some six-word sequence that occurs again in
the text are transformed: in a run, at least max(12, 2q) - q >= 6 consecutive
words equal those q places on, so every other block has no zero to find.
Distances that a run already found explains (multiples of its period inside
it) are not extended again.

Work on one text is bounded by its length and is done where its row lies:
nothing is shuffled, and a lost executor costs its rows again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import read_table, ship_package, word_array
from churnlens.llm.decontaminate import once

SHORTEST = 12
GRAM = SHORTEST // 2  # equal words q apart that every run has, one after the other
PRIME, ROOT = 998_244_353, 3  # PRIME - 1 is divisible by 2**23
LONGEST_TRANSFORM = 1 << 23
DIRECT_BELOW = 16  # blocks of fewer words: the sums are formed term by term
NUMBERS_AT_ONCE = 1 << 18  # numbers in a batch of transforms; a larger one goes alone
WORDS_KNOWN = 1_000_000

RUN = "start long, length long, period long"


@lru_cache(maxsize=64)
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """Powers 0 .. half - 1 of a root of unity of order 2 * half."""
    root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    step = pow(root, PRIME - 2, PRIME) if inverse else root
    out = np.ones(half, dtype=np.uint64)
    done = 1
    while done < half:  # doubling: out[done + i] = out[i] * step**done
        out[done:2 * done] = out[:done] * np.uint64(pow(step, done, PRIME)) % np.uint64(PRIME)
        done *= 2
    return out


def transform(a: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order."""
    p = np.uint64(PRIME)
    rows, size = a.shape
    half = size // 2
    while half:
        view = a.reshape(rows, -1, 2, half)
        low, high = view[:, :, 0], view[:, :, 1]
        out = np.empty_like(view)
        np.remainder(low + high, p, out=out[:, :, 0])
        np.remainder((low + (p - high)) * _twiddles(half, False), p, out=out[:, :, 1])
        a = out.reshape(rows, size)
        half //= 2
    return a


def inverse_transform(a: np.ndarray) -> np.ndarray:
    """Undoes :func:`transform`."""
    p = np.uint64(PRIME)
    rows, size = a.shape
    half = 1
    while half < size:
        view = a.reshape(rows, -1, 2, half)
        low, high = view[:, :, 0], view[:, :, 1] * _twiddles(half, True) % p
        out = np.empty_like(view)
        np.remainder(low + high, p, out=out[:, :, 0])
        np.remainder(low + (p - high), p, out=out[:, :, 1])
        a = out.reshape(rows, size)
        half *= 2
    return a * np.uint64(pow(size, PRIME - 2, PRIME)) % p


def correlations(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """sum_j blocks[r, j] * windows[r, o + j] modulo the prime, for the 2B offsets o of a window of 3B - 1."""
    rows, width = blocks.shape
    size = 4 * width
    if size > LONGEST_TRANSFORM:
        raise ValueError("a block is longer than the prime's transforms allow")
    a, b = np.zeros((rows, size), dtype=np.uint64), np.zeros((rows, size), dtype=np.uint64)
    a[:, :width] = blocks[:, ::-1]
    b[:, :windows.shape[1]] = windows
    product = transform(a) * transform(b) % np.uint64(PRIME)
    return inverse_transform(product)[:, width - 1:3 * width - 1]


def zero_distances(x: np.ndarray, starts: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block starts, distances) with a zero sum of squared differences, distances 2B - 1 .. 4B - 2."""
    n, first, offsets = len(x), 2 * width - 1, np.arange(2 * width)
    if width < DIRECT_BELOW:
        blocks = x[starts[:, None] + np.arange(width)].astype(np.int64)
        for q in (first + offsets).tolist():
            fits = np.flatnonzero(starts + (q + width) <= n)
            there = x[starts[fits, None] + np.arange(q, q + width)].astype(np.int64)
            s = starts[fits[((blocks[fits] - there) ** 2).sum(axis=1) == 0]]
            yield s, np.full(len(s), q)
        return
    if 4 * width > LONGEST_TRANSFORM:  # blocks beyond the transform: shorter ones of the same scale
        part = LONGEST_TRANSFORM // 4
        for at in range(0, 2 * width, 2 * part):
            yield from _transformed(x, starts, part, first + at)
        return
    yield from _transformed(x, starts, width, first)


def _transformed(x: np.ndarray, starts: np.ndarray, width: int, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Zero sums of the blocks of ``width`` words at distances first .. first + 2 * width - 1."""
    n, p = len(x), np.uint64(PRIME)
    squares = np.concatenate([[0], np.cumsum(x * x % p)]).astype(np.uint64)
    padded = np.concatenate([x, np.zeros(first + 4 * width, dtype=np.uint64)])
    offsets = np.arange(2 * width)
    each = max(1, NUMBERS_AT_ONCE // (4 * width))
    for at in range(0, len(starts), each):
        s = starts[at:at + each]
        dot = correlations(x[s[:, None] + np.arange(width)],
                           padded[s[:, None] + (first + np.arange(3 * width - 1))])
        begin = s[:, None] + (first + offsets)
        fits = begin + width <= n
        begin = np.where(fits, begin, 0)
        total = (squares[s + width] - squares[s])[:, None] + squares[begin + width] - squares[begin]
        row, o = np.nonzero(fits & ((total % p + (p - dot) + (p - dot)) % p == 0))
        yield s[row], first + o


def repeated(x: np.ndarray) -> np.ndarray | None:
    """Marks the words in a sequence of GRAM words that occurs more than once (hash: at least those); None if none is."""
    n = len(x)
    if n < SHORTEST:
        return None
    gram = np.zeros(n - GRAM + 1, dtype=np.uint64)
    for k in range(GRAM):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + (x[k:n - GRAM + 1 + k] + np.uint64(1))
        gram ^= gram >> np.uint64(29)
    order = np.sort(gram)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return None
    place = np.minimum(np.searchsorted(twice, gram), len(twice) - 1)
    begin = np.flatnonzero(twice[place] == gram)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + GRAM, -1)
    return np.cumsum(change[:n]) > 0


def stretch(x: np.ndarray, q: int, s: int) -> tuple[int, int]:
    """The longest [i, e) around s in which x[t] == x[t + q]; empty (s, s) if it fails at s."""
    e, step, limit = s, 32, len(x) - q
    while e < limit:
        m = min(step, limit - e)
        differ = x[e:e + m] != x[e + q:e + q + m]
        k = int(differ.argmax())
        if differ[k]:
            e += k
            break
        e, step = e + m, 2 * step
    if e == s:
        return s, s
    i, step = s, 32
    while i > 0:
        m = min(step, i)
        differ = (x[i - m:i] != x[i - m + q:i + q])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            i -= k
            break
        i, step = i - m, 2 * step
    return i, e


def find_runs(x: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word numbers, by start, then period."""
    n = len(x)
    x = np.asarray(x, dtype=np.uint64)
    covered = repeated(x)
    if covered is None:
        return []
    upto = np.concatenate([[0], np.cumsum(covered)])
    found: dict[tuple[int, int], int] = {}
    period, end = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)  # of the run that reaches furthest
    width = 1
    while 2 * width - 1 <= n // 2:
        starts = np.arange(0, n - (3 * width - 1) + 1, width)
        starts = starts[upto[starts + width] - upto[starts] == width]
        seeds = [[], []]
        for s, q in zero_distances(x, starts, width) if len(starts) else ():
            known = (period[s] > 0) & (end[s] >= s + q + width) & (q % np.maximum(period[s], 1) == 0)
            seeds[0].append(s[~known])
            seeds[1].append(q[~known])
        if seeds[0]:
            s, q = np.concatenate(seeds[0]), np.concatenate(seeds[1])
            order = np.lexsort((s, q))
            last_q, last_e = 0, 0
            for s, q in zip(s[order].tolist(), q[order].tolist()):
                if q == last_q and s < last_e:
                    continue
                if period[s] and q % period[s] == 0 and end[s] >= s + q + width:
                    continue
                i, e = stretch(x, q, s)
                last_q, last_e = q, e
                stop = e + q
                if stop - i < max(SHORTEST, 2 * q) or e <= s:
                    continue
                # of equal stretches the smallest period is the run's
                if found.setdefault((i, stop), q) == q:
                    further = np.flatnonzero(end[i:stop] < stop) + i
                    period[further], end[further] = q, stop
        width *= 2
    return sorted(((i, stop - i, q) for (i, stop), q in found.items()), key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Places of the words that no run contains after its first period."""
    drop = np.zeros(n, dtype=bool)
    for start, length, q in runs:
        drop[start + q:start + length] = True
    return np.flatnonzero(~drop)


class Numbering:
    """Numbers for words; started anew between texts when it has grown large."""

    def __init__(self):
        self.known = defaultdict(count().__next__)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > WORDS_KNOWN:
            self.__init__()
        return np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))


def collapse_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period), collapsed (text) of every row.

    Words are runs of characters other than space, tab and line ends.
    ``collapsed`` holds the words that no run contains after its first period,
    joined by one space.  Null and empty texts have no words, no runs and an
    empty collapsed text; repeated rows and null ids are rows like any other;
    extra columns are ignored; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    key = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Numbering()
        for batch in batches:
            sizes, runs, texts = [], [], []
            for raw in batch.column(1).cast(pa.large_binary()).to_pylist():
                words = (raw or b"").split()  # bytes part at the six separators only
                found = find_runs(number(words)) if len(words) >= SHORTEST else []
                sizes.append(len(words))
                runs.append([{"start": i, "length": m, "period": q} for i, m, q in found])
                texts.append(b" ".join([words[i] for i in kept_words(len(words), found)] if found else words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {key}, n_words long, runs array<struct<{RUN.replace(' ', ':').replace(',:', ',')}>>, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text, a tail of every tenth text made periodic.

    h is the crc32 of the decimal doc_id and g = h div 10.  If h is divisible
    by ten, word i >= a = g mod n becomes word a + (i - a) mod p with
    p = 1 + (n - a) div (3 + g mod 8).  A null doc_id leaves its text alone.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"),
                       once(F.when(h % 10 == 0, word_array(F.col("text"))), "w"))
    rows = rows.withColumn("n", F.size("w").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    moved = F.expr("array_join(transform(sequence(0L, n - 1), "
                   "i -> element_at(w, cast(if(i < a, i, a + (i - a) % p) + 1 as int))), ' ')")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), moved).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text of ``documents``, its planted periods included, and their digests."""
    rows = collapse_runs(with_planted_periods(read_table(spark, sf_dir, "documents")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as back, -r.period as small)))")
    listed = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                       F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
                       (-F.col("best.small")).alias("period"),
                       F.expr("1000 * best.length div -best.small").alias("exponent_milli"),
                       "runs_sha256", "collapsed_sha256")
