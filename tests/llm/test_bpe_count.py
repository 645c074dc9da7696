"""Heap-and-list counts equal the tokenizers library's."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from churnlens.llm import bpe_count

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def test_whole_table_equals_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = bpe_count.op7_token_counts(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r.doc_id])
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 512)


def test_edges_equal_library(spark, make_docs, edge_texts, library):
    rows = bpe_count.count_tokens(make_docs(list(enumerate(edge_texts)) + [(None, "a b"), (1, "")]), PATH).collect()
    got = {(r.doc_id, r.n_tokens) for r in rows}
    assert len(rows) == len(edge_texts) + 2
    assert got == {(i, library(t)) for i, t in enumerate(edge_texts)} | {(None, library("a b"))}


def test_empty_table(make_docs):
    assert bpe_count.count_tokens(make_docs([]), PATH).collect() == []


def test_cache_is_bounded_and_exact():
    seen = []
    cache = bpe_count.GenerationCache(lambda k: seen.append(k) or len(k), entries=3)
    assert [cache[k] for k in ("a", "bb", "ccc", "dddd", "a", "e" * 99)] == [1, 2, 3, 4, 1, 99]
    assert len(cache) <= 3 and "e" * 99 not in cache


def test_portions_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe_count, "TEXTS_AT_ONCE", 3)
    monkeypatch.setattr(bpe_count, "CHARACTERS_AT_ONCE", 10)
    texts = ["a", None, "b", "c" * 20, "d", "e" * 9, "f"]
    got = list(bpe_count.portions(texts))
    assert [t for _, part in got for t in part] == texts
    assert [(first, len(part)) for first, part in got] == [(0, 3), (3, 1), (4, 2), (6, 1)]
    assert list(bpe_count.portions([])) == []
