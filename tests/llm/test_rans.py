"""Coded files round-trip exactly, decode from checkpoints and detect damage."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from churnlens.llm import rans

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows):
    library, out, start = Tokenizer.from_file(PATH), [], 0
    coded = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    kind = np.dtype("<u2")
    for i, ids in sorted(coded, key=lambda x: (x[0] is not None, x[0] or 0, len(x[1]), np.array(x[1], kind).tobytes())):
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in rans.op2_rans_files(spark, SF).collect())
    assert got == expected(rows)


def test_edges_and_small_files(spark, make_docs, edge_texts, scratch):
    rows = [*enumerate(edge_texts), (None, "no id"), (3, "same id"), (3, "same id"), (-5, "negative")]
    layout = rans.Layout(lanes=8, frame_ids=64, checkpoint=2, file_ids=500)
    rans.write_corpus(make_docs(rows), f"{scratch}/a", PATH, 2, layout)
    got = [tuple(r) for r in rans.read_files(spark.newSession(), f"{scratch}/a").collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)
    rans.write_corpus(make_docs([]), f"{scratch}/b", PATH, 2)
    assert rans.read_files(spark, f"{scratch}/b").collect() == []


def test_lengths_are_the_encoders(edge_texts):
    rows = list(enumerate([*edge_texts, "abc.,; def!! x?", "word.", "...", "a<|endoftext|>."]))
    ids = {i: n - 1 for i, _, n, _ in expected(rows)}
    assert rans.Encoder(PATH, 2).counts([t for _, t in rows]).tolist() == [ids[i] for i, _ in rows]


def test_forgetting_changes_nothing(monkeypatch, edge_texts):
    library = Tokenizer.from_file(PATH)
    monkeypatch.setattr(rans, "PIECES_KNOWN", 5)
    monkeypatch.setattr(rans, "JOINED", 3)
    known = rans.Encoder(PATH, 2)
    for t in [*edge_texts, "one two three four five six seven eight", "\nnine\nten  eleven one\u2003two", *edge_texts]:
        want = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert np.frombuffer(known([t])[0].as_py(), dtype=known.kind).tolist() == want
    texts = [*edge_texts, "one two", None, "\x1c odd  spaces ", "three"]
    together = [np.frombuffer(b, dtype=known.kind).tolist() for b in rans.Encoder(PATH, 2)(texts).to_pylist()]
    assert together == [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert rans.Encoder(PATH, 2)([]).to_pylist() == []


@pytest.mark.parametrize("n,distinct", [(0, 5), (1, 1), (7, 3), (64, 2), (1000, 40), (5000, 50_257)])
def test_codec(n, distinct):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), distinct).astype(np.uint32) - 1
    table = rans.Table.from_counts(np.bincount(ids, minlength=distinct))
    assert not n or int(table.freq.sum()) == 1 << rans.SCALE
    layout = rans.Layout(lanes=16, checkpoint=3)
    data = rans.frame([5], [n], ids, table, layout)
    f = rans.Frame(memoryview(data))
    assert f.ids(table).tolist() == ids.tolist() and f.doc_ids == [5]
    span = 16 * 3
    for mark in range(len(f.places)):  # every checkpoint starts a decoder of its own
        assert f.ids(table, mark).tolist() == ids[mark * span:(mark + 1) * span].tolist()


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.5, 200_000), 1000).astype(np.uint32)
    counts = np.bincount(ids)
    p = counts[counts > 0] / len(ids)
    entropy = -(p * np.log2(p)).sum() * len(ids) / 8
    states, _, words = rans.encode(ids, rans.Table.from_counts(counts), 64, 1 << 20)
    assert words.nbytes + states.nbytes < 1.01 * entropy + 1024


def test_damage_is_found():
    ids = np.arange(300, dtype=np.uint32) % 7
    table = rans.Table.from_counts(np.bincount(ids))
    data = bytearray(rans.frame([1], [300], ids, table, rans.Layout(lanes=4)))
    data[-20] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.Frame(memoryview(bytes(data)))
    data[-20] ^= 1
    with pytest.raises(ValueError, match="another table"):
        rans.Frame(memoryview(bytes(data))).ids(rans.Table.from_counts(np.ones(9)))


def test_a_known_piece_is_looked_up_once():
    class Counting(dict):
        again = 0

        def __getitem__(self, key):
            self.again += 1
            return super().__getitem__(key)

    known = rans.Encoder(PATH, 2)
    known.known = Counting()
    first = known.places([" one", " two", "three"]).tolist()
    assert sorted(first) == [0, 1, 2] and known.known.again == 3
    assert known.places([" two", " four", "three", " one"]).tolist() == [first[1], 3, first[2], first[0]]
    assert known.known.again == 4  # the new one only
    assert known.places([" four"]).tolist() == [3] and known.places([]).tolist() == [] and known.known.again == 4
