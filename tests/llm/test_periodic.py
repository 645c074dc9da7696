"""Runs against brute force over all periods; the query against a plain loop over the whole table."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from churnlens.llm import periodic

SF = "/root/testdata/sf0.001"


def brute(x):
    found, n = {}, len(x)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and x[e] == x[e + q]:
                e += 1
            if e + q - i >= max(12, 2 * q):
                found.setdefault((i, e + q), q)
            i = max(e, i + 1) if e > i else i + 1
    return sorted(((i, j - i, q) for (i, j), q in found.items()), key=lambda r: (r[0], r[2]))


def runs(x):
    return periodic.find_runs(np.array(x, dtype=np.uint64))


@pytest.mark.parametrize("seed", range(60))
def test_random_sequences(seed):
    rng = random.Random(seed)
    letters = rng.choice([1, 2, 2, 3, 5])
    x = [rng.randrange(letters) for _ in range(rng.randrange(0, 160))]
    for _ in range(rng.randrange(4)):  # periodic stretches inside, with a break now and then
        p, at = rng.randrange(1, 60), rng.randrange(len(x) + 1)
        part = [rng.randrange(100) for _ in range(p)] * rng.randrange(1, 5)
        if rng.random() < 0.3:
            part[rng.randrange(len(part))] = 7
        x[at:at] = part
    assert runs(x) == brute(x)


def test_fibonacci_word_and_long_periods():
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    assert runs(b) == brute(b)
    rng = random.Random(1)
    long = [rng.randrange(10_000) for _ in range(3000)]
    x = [1, 2, 3, *long, *long, *long[:100], 5]
    assert runs(x) == [(3, 6100, 3000)]


def test_correlations_are_exact():
    rng = np.random.default_rng(0)
    for width in (16, 64, 256):
        b = rng.integers(0, periodic.PRIME, (3, width)).astype(np.uint64)
        w = rng.integers(0, periodic.PRIME, (3, 3 * width - 1)).astype(np.uint64)
        got = periodic.correlations(b, w)
        for r in range(3):
            want = [sum(int(u) * int(v) for u, v in zip(b[r], w[r, o:o + width])) % periodic.PRIME
                    for o in range(2 * width)]
            assert got[r].tolist() == want


def test_blocks_beyond_the_transform(monkeypatch):
    monkeypatch.setattr(periodic, "LONGEST_TRANSFORM", 64)
    rng = random.Random(2)
    part = [rng.randrange(50) for _ in range(211)]
    x = [*part, *part, *part[:40], 99, *([1, 2] * 80)]
    assert runs(x) == brute(x)


def test_accidental_zero_is_not_a_run(monkeypatch):
    monkeypatch.setattr(periodic, "PRIME", 257)  # small enough for sums that vanish by chance
    monkeypatch.setattr(periodic, "LONGEST_TRANSFORM", 256)
    periodic._twiddles.cache_clear()
    rng = random.Random(3)
    part = [rng.randrange(250) for _ in range(90)]
    x = [*part, *part[:80], 3, *part, *part, 8, *part[:70]]
    assert runs(x) == brute(x)
    monkeypatch.undo()
    periodic._twiddles.cache_clear()


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def expected(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    known = {}
    found = brute([known.setdefault(w, len(known)) for w in words])
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *top, sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in periodic.op12_periodic_runs(spark, SF).collect())
    assert got == sorted(expected(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 5


def test_edges(spark, make_docs, edge_texts, scratch):
    tenth = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [*enumerate(edge_texts), (None, "a b " * 20), (3, "same"), (3, "same"), (-5, "x y z " * 9),
            *((i, t) for i in tenth for t in (None, "", "one", "a b c d e f g " * 9, "é ü\x1cß 字 " * 30))]
    docs = make_docs(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                           "runs double, w long, collapsed long")
    docs.write.parquet(f"{scratch}/documents.parquet")
    got = sorted((tuple(r) for r in periodic.op12_periodic_runs(spark, scratch).collect()), key=str)
    assert got == sorted((expected(*r) for r in rows), key=str)
    assert periodic.collapse_runs(make_docs([])).collect() == []
