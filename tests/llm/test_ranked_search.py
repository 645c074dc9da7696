"""Ranked search against a plain loop: whole table, small slices and bundles, edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from churnlens.llm import ranked_search
from churnlens.llm.ranked_search import SearchConfig

SF = "/root/testdata/sf0.001"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def expected(docs, items, top=50):
    texts = [(i, words(t)) for i, t in docs]
    n_docs, total = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    df = Counter(t for _, w in texts for t in set(w))
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(words(t))
    out = []
    for i, ts in wanted.items():
        found = []
        for doc_id, w in texts:
            tf, m = Counter(w), 100 - 50 + (50 * len(w) * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in ts if tf[t])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(i, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got(ranked_search.op11_ranked_search(spark, SF)) == expected(docs, items)


@pytest.mark.parametrize("seed,cfg", [
    (1, SearchConfig(top=3, owners=3, slice_docs=7, slice_postings=40, bundle_items=2)),
    (2, SearchConfig(top=2, owners=5, slice_docs=50, bundle_items=100)),
    (3, SearchConfig(top=4, owners=1, block_terms=20, bundle_items=3)),
])
def test_slices_bundles_and_blocks_change_nothing(spark, make_docs, seed, cfg):
    rng = random.Random(seed)
    word = lambda: "w%d" % min(int(rng.paretovariate(0.6)), 60)
    docs = [(rng.randrange(150), " ".join(word() for _ in range(rng.randrange(0, 30)))) for _ in range(200)]
    docs += [(None, "w1 w2 w3"), (7, "w1 w2 w3"), (5, "w1 w2 w3"), (None, None)] + [(i, "w4 w5") for i in range(300, 340)]
    items = [(i, " ".join(word() for _ in range(8))) for i in range(9)] + [(3, "w1 W2"), (50, "nowhere"), (51, None), (None, "w4")]
    found = ranked_search.search(make_docs(docs), spark.createDataFrame(items, "item_id int, text string"), cfg)
    assert got(found) == expected(docs, items, cfg.top)


def test_edges(spark, make_docs, edge_texts):
    items = spark.createDataFrame([(1, "A été 🙂🙂 w ab_x", 2.0), (1, "字 three", 1.0), (2, "", None)],
                                  "item_id long, text string, score double")
    docs = [*enumerate(edge_texts), (3, "same a"), (3, "same a")]
    found = ranked_search.search(make_docs(docs), items)
    assert got(found) == expected(docs, [(1, "A été 🙂🙂 w ab_x"), (1, "字 three"), (2, "")])
    assert ranked_search.search(make_docs([]), items).collect() == []
    assert ranked_search.search(make_docs([(1, "...")]), items).collect() == []
    assert ranked_search.search(make_docs(docs), items.where("item_id = 9")).collect() == []


def test_owners_share_the_postings():
    df = np.array([5, 1, 100, 1, 30, 3])
    owner = ranked_search.owners_of(df, 4)
    assert owner.min() == 0 and owner.max() <= 3 and all(owner[a] <= owner[b] for a in range(6) for b in range(6) if df[a] < df[b])
