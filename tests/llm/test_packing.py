"""Boundaries against exhaustive search; batches against their rules."""

import itertools
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from churnlens.llm import packing
from churnlens.llm.common import numbered

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def cost(lengths, counts, bounds):
    return sum(c * next(b for b in sorted(bounds) if b >= x) for x, c in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(30))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(8, 400, 8), rng.randrange(1, 9)))
    counts = [rng.randrange(1, 50) for _ in lengths]
    for buckets in range(1, 6):
        got = packing.optimal_boundaries(np.array(lengths), np.array(counts), buckets)
        best = min(cost(lengths, counts, (*c, lengths[-1]))
                   for k in range(min(buckets, len(lengths)))
                   for c in itertools.combinations(lengths[:-1], k))
        assert len(got) <= buckets and got[-1] == lengths[-1] and cost(lengths, counts, got) == best


def test_boundaries_of_nothing_and_of_many():
    assert packing.optimal_boundaries(np.array([]), np.array([]), 4) == []
    lengths = np.arange(8, 65_544, 8)
    got = packing.optimal_boundaries(lengths, 1 + lengths % 97, 16)
    assert len(got) == 16 and got[-1] == lengths[-1]


def check(rows, n, cfg):
    assert len(rows) == n
    used = Counter()
    for r in rows:
        own = max(-(-r.n_tokens // cfg.multiple), 1) * cfg.multiple
        assert r.bucket >= own and r.padding == r.bucket - r.n_tokens
        assert own <= cfg.budget or r.bucket == own
        used[r.bucket, r.batch] += 1
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == n
    for bucket in {b for b, _ in used}:
        full = max(cfg.budget // bucket, 1)
        sizes = [used[bucket, k] for k in range(len([1 for b, _ in used if b == bucket]))]
        assert all(s == full for s in sizes[:-1]) and 1 <= sizes[-1] <= full
    within = sorted({r.bucket for r in rows if r.bucket <= cfg.budget})
    lengths = Counter(max(-(-r.n_tokens // cfg.multiple), 1) * cfg.multiple for r in rows)
    inside = sorted(x for x in lengths if x <= cfg.budget)
    assert within == packing.optimal_boundaries(np.array(inside), np.array([lengths[x] for x in inside]), cfg.buckets)


def test_whole_table(spark):
    check(packing.op4_length_buckets(spark, SF).collect(), 200, packing.PackingConfig())


def test_edges(make_docs, edge_texts):
    cfg = packing.PackingConfig(budget=256, buckets=3)
    rows = [*enumerate(edge_texts), (None, None), (3, "same"), (3, "same"), *((100 + i, "word " * (i % 40)) for i in range(200))]
    check(packing.pack(make_docs(rows), PATH, cfg).collect(), len(rows), cfg)
    assert packing.pack(make_docs([]), PATH, cfg).collect() == []


def test_numbered_counts_each_group(spark):
    rows = [(g, i % 50) for g, n in ((1, 400), (2, 3), (None, 5)) for i in range(n)]
    got = numbered(spark.createDataFrame(rows, "g int, x int"), ["g"], ["x"], "position", "test").collect()
    for g, n in ((1, 400), (2, 3), (None, 5)):
        part = sorted((r.position, r.x) for r in got if r.g == g)
        assert [p for p, _ in part] == list(range(n)) and [x for _, x in part] == sorted(x for _, x in part)
