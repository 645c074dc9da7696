"""Leaks against brute force over all windows."""

import random
import re
from collections import Counter

import duckdb
import pytest

from churnlens.llm import decontaminate as dc

SF = "/root/testdata/sf0.001"


def slow(docs, items):
    """{(doc_id, item_id): (similarity, start)} by comparing every window."""
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = {}
    for item_id, text in items:
        iw = split(text)
        k = min(5, len(iw))
        if not iw:
            continue
        want = [tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)]
        c = Counter(want)
        for doc_id, text in docs:
            w = split(text)
            have = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]
            for s in range(len(have) - len(want) + 1):
                shared = sum((Counter(have[s:s + len(want)]) & c).values())
                sim = shared / (2 * len(want) - shared)
                if sim >= 0.8 and sim > out.get((doc_id, item_id), (0, 0))[0]:
                    out[doc_id, item_id] = (sim, s)
    return out


def check(rows, want):
    assert {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in rows} == want


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def planted():
    rng = random.Random(8)
    vocab = [a + b for a in "bcdfghklm" for b in ("a", "en", "or", "ith")]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, say(rng.randrange(6, 60))) for i in range(12)] + [(50, ["tiny", "item"]), (51, []), (None, say(20))]
    docs = []
    for d in range(40):
        _, passage = rng.choice(items)
        passage = list(passage)
        if d % 4 == 1 and len(passage) > 30:
            passage[1] = "changed"
        if d % 4 == 2:
            passage = passage[: len(passage) // 2]
        if d % 4 == 3:
            passage = [w.upper() + "," for w in passage]
        docs.append((d, " ".join(say(rng.randrange(30)) + passage + say(rng.randrange(40)))))
    docs += [(100, None), (101, ""), (102, " ".join(["tiny", "item"] * 50)), (103, "w " * 3000), (0, docs[0][1])]
    return docs, [(i, " ".join(w)) for i, w in items]


def test_planted_passages(spark, make_docs):
    docs, items = planted()
    rows = dc.find_leaks(make_docs(docs), benchmark(spark, items + items[:1])).collect()
    want = slow(docs, items)
    assert len(want) > 20
    check(rows, want)
    kept = dc.keep_unleaked(make_docs(docs), benchmark(spark, items))
    assert "_doc" not in kept.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {d for d, _ in want}


def test_a_large_benchmark_takes_several_passes(spark, make_docs, monkeypatch):
    monkeypatch.setattr(dc, "SHINGLES_AT_ONCE", 100)
    docs, items = planted()
    check(dc.find_leaks(make_docs(docs), benchmark(spark, items)).collect(), slow(docs, items))


def test_recall_of_the_radius(spark, make_docs):
    """Of windows at a similarity of 0.8 and little more, the fingerprints miss hardly any."""
    rng = random.Random(11)
    item = [f"word{i}" for i in range(60)]
    docs = []
    for d in range(1500):
        w = list(item)
        at = rng.randrange(50)
        for i in range(rng.choice([1, 1, 1, 2])):  # one changed word costs five of 56 shingles: 51 / 61 = 0.836
            w[min(at + i, 59)] = f"other{d}_{i}"
        docs.append((d, " ".join(w)))
    want = slow(docs, [(1, " ".join(item))])
    got = {r.doc_id for r in dc.find_leaks(make_docs(docs), benchmark(spark, [(1, " ".join(item))])).collect()}
    assert len(want) > 1000 and got <= {d for d, _ in want} and len(got) >= 0.99 * len(want)


def test_null_ids_and_the_sql_with_short_texts(spark, make_docs, scratch):
    rng = random.Random(4)
    words = [f"{rng.choice('bcd')}{i}" for i in range(38)]
    docs = [(1, " ".join(words[:36])), (2, " ".join(words[:20])), (3, " ".join(["x", *words, "y"])), (4, "a b"), (5, None),
            (6, " ".join(words[2:]))]
    items = [(1, " ".join(words)), (2, "tiny item")]
    got = dc.find_leaks(make_docs([*docs, (None, " ".join(words[:37]))]), benchmark(spark, items)).drop("hamming")
    rows = sorted(map(tuple, got.select("doc_id", "item_id", "start_word", "n_words", "similarity").collect()), key=str)
    assert [r for r in rows if r[0] is None] == [(None, 1, 0, 37, 33 / 34)]
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.sql("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    want = con.sql(dc.OP8_SQL).select("doc_id, item_id, start_word, n_words, similarity").fetchall()
    assert sorted(want, key=str) == [r for r in rows if r[0] is not None] and len(want) == 3


def test_whole_tables_equal_brute_force_and_sql(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = dc.op8_simhash_decontamination(spark, SF)
    check(got.collect(), slow(docs, items))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(dc.OP8_SQL)
    order = sorted(got.columns)
    assert sorted(want.columns) == order
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(want.select(", ".join(order)).fetchall())


@pytest.mark.parametrize("n", [1, 2, 3, 40, 400])
def test_majority(spark, n):
    rng = random.Random(n)
    hashes = [dc.signed(rng.getrandbits(64)) for _ in range(n)]
    got = spark.createDataFrame([(hashes,)], "h array<long>").select(dc.majority("h").alias("fp")).first().fp
    mask = (1 << 64) - 1
    assert got & mask == sum(1 << b for b in range(64) if 2 * sum((h & mask) >> b & 1 for h in hashes) > n)


def test_blocks_cover_the_fingerprint():
    masks = [m & (1 << 64) - 1 for m in dc.blocks(dc.RADIUS)]
    assert len(masks) == dc.RADIUS + 1 and sum(masks) == (1 << 64) - 1 and all(masks)


def test_empty_tables(spark, make_docs):
    _, items = planted()
    assert dc.find_leaks(make_docs([]), benchmark(spark, items)).collect() == []
    assert dc.find_leaks(make_docs([(1, "some text")]), benchmark(spark, [])).collect() == []
    assert dc.keep_unleaked(make_docs([(1, "some text")]), benchmark(spark, [])).count() == 1


def test_a_text_shorter_than_the_item_is_one_window(spark, make_docs):
    rng = random.Random(3)
    item = [f"{rng.choice('bcdfg')}{i}" for i in range(38)]
    twice = (["one", "and", "the", "same", "run"] * 8)[:38]
    docs = [(1, item[:36]), (2, item[2:]), (3, item[:32]), (4, item[:31]), (5, item[:30]), (6, item[:20]),
            (7, item[:34] + ["other", "end"]), (8, twice[:35]), (9, item[:37]), (10, item)]
    docs = [(i, " ".join(w)) for i, w in docs]
    items = [(0, " ".join(item)), (1, " ".join(twice))]
    want = {}
    for item_id, text in items:
        whole = [tuple(text.split()[i:i + 5]) for i in range(34)]
        for doc_id, t in docs:
            w = t.split()
            have = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
            shared = sum((Counter(have) & Counter(whole)).values())
            if shared / (len(have) + 34 - shared) >= 0.8:
                want[doc_id, item_id] = (shared / (len(have) + 34 - shared), 0, len(w))
    assert {1, 2, 3, 8} <= {d for d, _ in want} and want[1, 0][0] == 32 / 34 and (6, 0) not in want
    rows = dc.find_leaks(make_docs(docs), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id): (r.similarity, r.start_word, r.n_words) for r in rows} == want
    kept = dc.keep_unleaked(make_docs(docs), benchmark(spark, items)).collect()
    assert {r.doc_id for r in kept} == {i for i, _ in docs} - {d for d, _ in want}


def test_majority_of_more_hashes_than_16_bits_count(spark):
    ones, bit = -1, 1 << 40
    got = spark.createDataFrame([([ones] * 70_000,), ([bit] * 40_000 + [0] * 39_999,), ([bit] * 40_000 + [0] * 40_000,)],
                                "h array<long>").select(dc.majority("h").alias("fp")).collect()
    assert [r.fp for r in got] == [ones, bit, 0]


def test_an_item_of_any_length_is_found(spark, make_docs):
    words = [f"w{i}" for i in range(66_000)]
    docs = [(1, " ".join(["before", "it", *words, "after"])), (2, " ".join(words[:-3])), (3, " ".join(words[:9]))]
    rows = dc.find_leaks(make_docs(docs), benchmark(spark, [(7, " ".join(words))])).collect()
    assert sorted((r.doc_id, r.item_id, r.start_word, r.n_words) for r in rows) == [(1, 7, 2, 66_000), (2, 7, 0, 65_997)]
    assert {r.doc_id: r.similarity for r in rows} == {1: 1.0, 2: 65_993 / 65_996}
