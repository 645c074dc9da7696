"""Segment search against brute force; held-out quality; edges."""

import math
import random
import zlib

import numpy as np
import pytest

from churnlens.llm import toxicity

SF = "/root/testdata/sf0.1"


def slow_segments(scores):
    """Ruzzo and Tompa's definition by recursion: take the best segment, then both sides."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > 0 and (best is None or s > best[2] + 1e-9 or abs(s - best[2]) < 1e-9 and j - i < best[1] - best[0]):
                best = (i, j, s)
    if best is None:
        return []
    i, j, s = best
    return slow_segments(scores[:i]) + [best] + [(a + j, b + j, c) for a, b, c in slow_segments(scores[j:])]


def test_all_maximal_segments():
    rng = random.Random(5)
    for _ in range(200):
        scores = [rng.choice([-3.0, -1.5, -1.1, -0.7, 0.9, 2.3, 4.1]) + rng.random() / 50 for _ in range(rng.randrange(14))]
        got = sorted(toxicity.segments(np.array(scores)))
        want = sorted(slow_segments(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_segment_search_is_linear():
    scores = np.tile([1.0, -0.9], 100_000)
    assert len(toxicity.segments(scores)) == 1
    assert len(toxicity.segments(np.tile([1.0, -1.1], 100_000))) == 100_000


def test_held_out_documents(spark):
    rows = toxicity.op3_toxic_segments(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    hit = sum(p and t for p, t in held)
    assert hit / sum(t for _, t in held) > 0.85
    assert hit / sum(p for p, _ in held) > 0.85


def labelled(spark, n, toxic):
    labels = [(i, 1, toxic(i)) for i in range(n)]
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_edges_and_passages(spark, make_docs, edge_texts):
    rng = random.Random(2)
    words = [a + b + c for a in ("ba", "ce", "di", "fo", "gu") for b in ("lan", "mer", "nit", "rov") for c in "aeiouy"]
    bad = ["scumword", "vileterm", "foulnoun"]
    texts = [" ".join(rng.choice(bad if i % 2 and 20 <= k < 24 else words) for k in range(60)) for i in range(300)]
    docs = make_docs([*enumerate(texts), *((1000 + i, t) for i, t in enumerate(edge_texts)), (None, texts[1]), (5, texts[5])])
    labels = labelled(spark, 300, lambda i: i % 2)
    rows = toxicity.score_documents(docs, labels).collect()
    assert len(rows) == 302 + len(edge_texts)
    by = {r.doc_id: r for r in rows}
    assert all(by[i].predicted == i % 2 for i in range(300))
    assert all(by[1000 + i].predicted == 0 for i in range(len(edge_texts)))
    model = toxicity.fit(docs, labels)
    found = {r.doc_id: (r.first_word, r.end_word) for r in toxicity.passages(docs.where("doc_id < 300"), model).collect()}
    assert found == {i: (20, 24) for i in range(1, 300, 2)}
    assert all(by[i].n_passages == i % 2 for i in range(300)) and by[1000].n_passages == 0
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id < 300").collect()) == list(range(0, 300, 2))


def test_without_labels_or_documents(spark, make_docs):
    none = labelled(spark, 0, lambda i: 0)
    docs = make_docs([(1, "some text"), (2, None)])
    assert {(r.doc_id, r.predicted) for r in toxicity.score_documents(docs, none).collect()} == {(1, 0), (2, 0)}
    one_class = labelled(spark, 3, lambda i: 0)
    assert all(r.predicted == 0 for r in toxicity.score_documents(docs, one_class).collect())
    assert toxicity.score_documents(make_docs([]), none).collect() == []


def test_every_significant_passage_counts():
    model = toxicity.ToxicityModel()
    weak = [model.log_p([6.0] * r, 100) for r in range(1, 60)]  # each a little above chance
    assert all(a < b for a, b in zip(weak, weak[1:]))
    assert model.log_p([9.0, 6.0] + [4.0] * 50, 100) == model.log_p([9.0, 6.0], 100)  # chance segments add nothing
    assert model.log_p([4.0] * 50, 100) == model.log_p([], 100) == 0


def test_chance_segments_follow_the_law():
    """Clean token scores drawn at random: the share of texts whose best segment reaches s is what the law says."""
    rng = np.random.default_rng(4)
    plain, bins = math.log(1 - 0.05), {40: 300, 20: 700}
    draw = np.concatenate([np.full(99_000, plain), np.full(300, 2.0), np.full(700, 1.0)])
    decay = toxicity._decay(bins, 100_000, plain)
    assert abs(np.exp(decay * draw).mean() - 1) < 1e-6
    n, best = 400, []
    for _ in range(1500):
        best.append(max((s for *_, s in toxicity.segments(rng.choice(draw, n))), default=0.0))
    best = np.array(best)
    scale = max(1, (best > 0).sum()) / (n * np.exp(-decay * best)).sum()
    model = toxicity.ToxicityModel(decay=decay, scale=scale)
    for s in (3.0, 4.0, 5.0):
        want = 1 - math.exp(-model.expected(s, n))
        assert abs((best >= s).mean() - want) < 0.35 * want + 0.01
    assert model.log_p([5.0], n) == pytest.approx(max(0.0, -math.log(model.expected(5.0, n))), abs=1e-9)
