"""Fingerprints, the pigeonring join and the components against brute force."""

import random

import pytest
import xxhash

from churnlens.llm import simhash
from churnlens.llm.common import connected_components

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for s in "\t\n\x0b\x0c\r":
        low = low.replace(s, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(points):
    """{index: component} over all pairs within 2 bits."""
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(points))]


def check(rows, texts):
    """rows against brute force over (doc_id, text) pairs with distinct ids."""
    points = [slow_fingerprint(t) for _, t in texts]
    comp = slow_components(points)
    least = {}
    for (i, _), c in zip(texts, comp):
        least[c] = min(least.get(c, i), i)
    want = {(i, f"{p:016x}", least[c]) for (i, _), p, c in zip(texts, points, comp)}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == want and len(rows) == len(texts)


def test_whole_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(simhash.op6_simhash_dedup(spark, SF).collect(), texts)


def test_edges(make_docs, edge_texts):
    texts = list(enumerate(edge_texts))
    check(simhash.near_duplicates(make_docs(texts)).collect(), texts)
    assert simhash.near_duplicates(make_docs([])).collect() == []


@pytest.mark.parametrize("bucket,segments", [(2, 7), (64, 7), (3, 4), (64, 5)])
def test_links_connect_what_brute_force_connects(spark, bucket, segments):
    rng = random.Random(segments)
    base = [rng.getrandbits(64) for _ in range(6)]
    points = {0, (1 << 64) - 1}
    for b in base:  # clouds and chains around a few centres
        for _ in range(50):
            points.add(b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(3))) & (1 << 64) - 1)
        for _ in range(20):
            b ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            points.add(b)
    points = sorted(points)
    fps = spark.createDataFrame([(simhash.signed(p),) for p in points], "fp long")
    links = simhash.hamming_links(fps, 2, segments, bucket)
    assert all(bin((r.u ^ r.v) & (1 << 64) - 1).count("1") <= 2 for r in links.collect())
    roots = {r.node: r.root for r in connected_components(links).collect()}
    got = [roots.get(simhash.signed(p), simhash.signed(p)) for p in points]
    want = slow_components(points)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_one_of_each_group_stays(make_docs):
    a, b = "one two three four five six seven", "quite another text with other words in it"
    docs = make_docs([(7, a), (3, a.upper()), (9, b), (9, b), (None, a), (4, None), (5, ""), (11, b)])
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, 3, 4, 9]
