"""Token-id files coded by a static range asymmetric numeral system.

A file is a sequence of independent frames.  A frame holds consecutive whole
documents: their ids, an index (doc_id, number of ids), and the coded ids.  All
files of a data set share one frequency table.  Inside a frame ids go round
robin to ``lanes`` interleaved coder states, so a step codes one id per lane
with vector operations.  The states at every ``checkpoint`` steps are kept with
their place in the word stream: a decoder can start at any of them, so parts of
a frame decode in parallel.  Checksums cover the ids and the frame.

The states are 64 bit and renormalise by 32-bit words: before coding an id of
frequency f (out of 2**SCALE) a state at or above f << (63 - SCALE) emits its
low word, which keeps states in [2**31, 2**63).

Frames leave through Spark's text sink, whose line separator is the zero byte
that ends every frame.  A data set is a folder: ``table`` holds the shared
frequencies with their checksum, ``ids`` the frames, so any session that is
given the path can decode it.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.bpe_count import cut, portions
from churnlens.llm.common import read_table, shared_path, ship_package, stored

SCALE = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
MAGIC = b"RNSF"
# magic, version, scale, lanes, checkpoint steps, table crc, documents, ids, words, checkpoints, crc of the ids
HEAD = struct.Struct("<4sBBHIIIQQII")
VERSION = 1
# Pieces and ids held per worker (about 170 bytes a piece), pieces joined for the library.
PIECES_KNOWN = 600_000
IDS_KNOWN = 8_000_000
JOINED = 200
BATCH = 50
SEPARATORS = frozenset(["", *map(chr, range(0x2000, 0x200b)), *"\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"])


@dataclass(frozen=True)
class Layout:
    """Lanes per step, ids per frame (a longer document has its own), steps between checkpoints, ids per file."""

    lanes: int = 2048
    frame_ids: int = 1 << 20
    checkpoint: int = 128
    file_ids: int = 1 << 24


class Table:
    """Frequencies that sum to 2**SCALE; every id that occurs has at least one."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        ends = np.cumsum(self.freq)
        self.start = ends - self.freq
        self.limit = self.freq << np.uint64(63 - SCALE)
        self.slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        self.crc = zlib.crc32(self.freq.astype("<u4").tobytes())

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Table:
        counts = counts.astype(np.float64)
        used = counts > 0
        room = (1 << SCALE) - int(used.sum())
        if room < 0:
            raise ValueError("more distinct ids than the table has slots")
        freq = np.where(used, 1 + np.floor(counts / max(1.0, counts.sum()) * room), 0).astype(np.int64)
        if used.any():
            freq[counts.argmax()] += (1 << SCALE) - int(freq.sum())
        return cls(freq)


def encode(ids: np.ndarray, table: Table, lanes: int, every: int) -> tuple[np.ndarray, list[int], np.ndarray]:
    """(states at each checkpoint, their places in the words, words)."""
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, LOW, dtype=np.uint64)
    emitted: list[np.ndarray] = []
    sizes = np.zeros(steps, dtype=np.int64)
    kept: list[np.ndarray] = []
    low_word, scale = np.uint64(0xFFFFFFFF), np.uint64(SCALE)
    for t in range(steps - 1, -1, -1):
        row = ids[t * lanes:(t + 1) * lanes]
        x, f = state[:len(row)], table.freq[row]
        over = np.flatnonzero(x >= table.limit[row])
        if len(over):
            high = x[over]
            emitted.append((high & low_word).astype("<u4"))
            sizes[t] = len(over)
            x[over] = high >> WORD
        q = x // f
        state[:len(row)] = (q << scale) + (x - q * f) + table.start[row]
        if t % every == 0:
            kept.append(state.copy())
    places = np.concatenate([[0], np.cumsum(sizes)])[:steps:every].tolist()
    words = np.concatenate(emitted[::-1]) if emitted else np.zeros(0, dtype="<u4")
    return np.array(kept[::-1], dtype="<u8").reshape(-1, lanes), places, words


def decode(state: np.ndarray, words: np.ndarray, n: int, table: Table) -> np.ndarray:
    """The first ``n`` ids from these states and the words that follow them."""
    lanes, out, at = len(state), np.empty(n, dtype=np.uint32), 0
    state = state.astype(np.uint64)
    mask, scale = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for first in range(0, n, lanes):
        x = state[:min(lanes, n - first)]
        slot = x & mask
        row = table.slots[slot]
        out[first:first + len(x)] = row
        x = table.freq[row] * (x >> scale) + slot - table.start[row]
        under = np.flatnonzero(x < LOW)
        if len(under):
            x[under] = (x[under] << WORD) | words[at:at + len(under)].astype(np.uint64)
            at += len(under)
        state[:len(x)] = x
    return out


def frame(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, table: Table, layout: Layout) -> bytes:
    """One frame, without the zero byte that the sink adds."""
    states, places, words = encode(ids, table, layout.lanes, layout.checkpoint)
    head = HEAD.pack(MAGIC, VERSION, SCALE, layout.lanes, layout.checkpoint, table.crc, len(doc_ids), len(ids),
                     len(words), len(places), zlib.crc32(ids.astype("<u4").tobytes()))
    body = head + b"".join((
        np.array([i is not None for i in doc_ids], dtype=np.uint8).tobytes(),
        np.array([i or 0 for i in doc_ids], dtype="<i8").tobytes(), np.array(lengths, dtype="<u8").tobytes(),
        np.array(places, dtype="<u8").tobytes(), states.astype("<u8").tobytes(), words.astype("<u4").tobytes()))
    return body + struct.pack("<I", zlib.crc32(body))


class Frame:
    """A parsed frame; ids are decoded on request, whole or from a checkpoint."""

    def __init__(self, data: memoryview):
        (magic, version, scale, self.lanes, self.every, self.table_crc, docs, self.n, words, marks,
         self.ids_crc) = HEAD.unpack_from(data)
        if magic != MAGIC or version != VERSION or scale != SCALE:
            raise ValueError("not a frame of this format")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        known = take("u1", docs)
        self.doc_ids = [int(i) if k else None for k, i in zip(known, take("<i8", docs))]
        self.lengths = take("<u8", docs).astype(np.int64)
        self.places = take("<u8", marks)
        self.states = take("<u8", marks * self.lanes).reshape(marks, self.lanes)
        self.words = take("<u4", words)
        if struct.unpack_from("<I", data, at)[0] != zlib.crc32(data[:at]):
            raise ValueError("frame checksum differs")
        self.size = at + 4

    def ids(self, table: Table, mark: int | None = None) -> np.ndarray:
        """All ids, verified; or those from one checkpoint to the next."""
        if table.crc != self.table_crc:
            raise ValueError("the frame was coded with another table")
        if mark is not None:
            span = self.lanes * self.every
            return decode(self.states[mark], self.words[int(self.places[mark]):], min(span, self.n - mark * span), table)
        out = decode(self.states[0], self.words, self.n, table) if self.n else np.zeros(0, dtype=np.uint32)
        if zlib.crc32(out.astype("<u4").tobytes()) != self.ids_crc:
            raise ValueError("checksum of the ids differs")
        return out


def frames(content: bytes) -> Iterator[Frame]:
    """The frames of a file in order."""
    view, at = memoryview(content), 0
    while at < len(view):
        found = Frame(view[at:])
        yield found
        at += found.size + 1


class Encoder:
    """Ids of whole texts by the tokenizers library, through a cache of pieces.

    A text is cut at places that the byte-level pre-tokenizer always cuts.
    Pieces not yet known go to the library, many joined to one text if each
    begins with a single separator; the bytes that every id stands for tell
    where the ids of a piece end.  Ids of known pieces lie in one array; when
    it or the number of pieces has grown too large, all are forgotten.
    """

    def __init__(self, vocab_path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocab_path)
        self.vocabulary = max(self.tokenizer.get_vocab_size(), end_id + 1)
        self.kind = "<u2" if self.vocabulary <= 1 << 16 else "<u4"
        self.end = np.array([end_id], dtype=self.kind).tobytes()
        # a byte-level vocabulary writes every byte as one character
        self.bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.vocabulary)], dtype=np.int64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype=self.kind)
        self.ends = np.zeros(1 << 16, dtype=np.int64)  # ends[k], ends[k + 1] bound piece k; ends[0] stays 0

    def raw(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), BATCH):  # the library's results take a hundred bytes an id: few at a time
            out += [np.array(e.ids, dtype=self.kind)
                    for e in self.tokenizer.encode_batch_fast(texts[i:i + BATCH], add_special_tokens=False)]
        return out

    def coded(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The pieces in another order, all their ids, the number of ids of each."""
        joined, alone = [], []
        for p in pieces:
            (joined if p[0] in " \n" and p[1:2] not in SEPARATORS else alone).append(p)
        length = pc.binary_length(pa.array(joined, pa.large_string())).to_numpy()
        groups = [joined[i:i + JOINED] for i in range(0, len(joined), JOINED)]
        found = self.raw(["".join(g) for g in groups])
        order, ids, sizes = [], [], []
        for g, (group, got) in enumerate(zip(groups, found)):
            upto = np.cumsum(self.bytes[got])
            ends = np.cumsum(length[g * JOINED:(g + 1) * JOINED])
            at = np.searchsorted(upto, ends) + 1
            if upto[-1:] != ends[-1] or (upto[at - 1] != ends).any():
                raise ValueError("the vocabulary is not byte-level")
            order += group
            ids.append(got)
            sizes.append(np.diff(at, prepend=0))
        found = self.raw(alone)
        ids += found
        sizes.append(np.array([len(f) for f in found], dtype=np.int64))
        return order + alone, np.concatenate([*ids, np.zeros(0, dtype=self.kind)]), np.concatenate(sizes)

    def places(self, pieces: list[str]) -> np.ndarray:
        """The number under which each piece is known; unknown ones are learnt first."""
        found = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            if len(self.known) + len(missing) > PIECES_KNOWN or self.ends[len(self.known)] > IDS_KNOWN:
                self.forget()
                missing = np.arange(len(pieces))
            new = [pieces[i] for i in missing.tolist()]
            order, ids, sizes = self.coded(new)
            n, used = len(self.known), int(self.ends[len(self.known)])
            self.ids = room(self.ids, used + len(ids))
            self.ids[used:used + len(ids)] = ids
            self.ends = room(self.ends, n + len(order) + 1)
            self.ends[n + 1:n + len(order) + 1] = used + np.cumsum(sizes)
            self.known.update(zip(order, range(n, n + len(order))))
            found[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        return found

    def __call__(self, texts: Sequence[str | None]) -> pa.Array:
        """The ids of each text with the end id, as little-endian bytes.

        The bytes of the distinct pieces, and the end id as one more, form an
        Arrow array; taking its elements in the order of the texts' pieces
        leaves all ids in one buffer, which only needs the texts' bounds.
        """
        kind, width = pa.large_binary(), np.dtype(self.kind).itemsize
        parts, places = [], []
        for at, pieces, index, ends in cut(texts):
            place = self.places(pieces)
            start = self.ends[place]
            own = self.ends[place + 1] - start
            upto = np.cumsum(own)
            total = int(upto[-1]) if len(upto) else 0
            ids = self.ids[np.repeat(start - (upto - own), own) + np.arange(total)].tobytes() + self.end
            offsets = np.concatenate([[0], upto, [total + 1]]) * width
            known = pa.Array.from_buffers(kind, len(pieces) + 1, [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
            taken = known.take(pa.array(np.insert(index.astype(np.int64), ends, len(pieces))))
            bounds = np.frombuffer(taken.buffers()[1], dtype=np.int64)[:len(taken) + 1]
            bounds = bounds[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
            data = taken.buffers()[2] or pa.py_buffer(b"")
            parts.append(pa.Array.from_buffers(kind, len(at), [None, pa.py_buffer(bounds.copy()), data]))
            places.append(at)
        if len(parts) == 1:
            return parts[0].cast(pa.binary())
        if not parts:
            return pa.array([], pa.binary())
        return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(places)))).cast(pa.binary())

    def counts(self, texts: Sequence[str | None]) -> np.ndarray:
        """The number of ids of each text, without the end id."""
        out = np.zeros(len(texts), dtype=np.int64)
        for first, some in portions(texts):
            for at, pieces, index, ends in cut(some):
                place = self.places(pieces)
                upto = np.concatenate([[0], np.cumsum((self.ends[place + 1] - self.ends[place])[index])])
                out[first + at] = np.diff(upto[np.concatenate([[0], ends])])
        return out


def room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, at least ``size`` long; it doubles when it grows."""
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), dtype=array.dtype)
    out[:len(array)] = array
    return out


@lru_cache(maxsize=2)
def encoder(vocab_path: str, end_id: int) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(vocab_path, end_id)


def length_udf(vocab_path: str):
    """A vectorised text -> number of ids function (null counts as empty, no end id)."""

    @F.pandas_udf("long")
    def n_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = encoder(vocab_path, 0)
        for batch in texts:
            yield pd.Series(known.counts(batch.tolist()), dtype="int64")
        known.forget()  # a worker that goes on to other work holds no pieces

    return n_tokens


def tokenized(docs: DataFrame, vocab_path: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian, end id appended) of every row, and histogram rows.

    A task that has seen all its rows adds one row whose ``seen`` lists how
    often each id occurred in them; it is null in the rows of documents.
    """
    ship_package(docs.sparkSession)
    known = Encoder(vocab_path, end_id)
    kind, width, vocabulary = known.kind, np.dtype(known.kind).itemsize, known.vocabulary
    key = docs.schema["doc_id"].dataType.simpleString()

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(vocab_path, end_id)
        total, keys = np.zeros(vocabulary, dtype=np.int64), None
        counted = pa.list_(pa.struct([("id", pa.int32()), ("n", pa.int64())]))

        def rows(doc_ids, lengths, raw, seen) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([doc_ids, lengths, raw, seen], names=["doc_id", "n_tokens", "ids", "seen"])

        for batch in batches:
            keys = batch.column(0).type
            for first, texts in portions(batch.column(1).to_pylist()):
                raw = encode_texts(texts)
                ends = np.frombuffer(raw.buffers()[1], dtype=np.int32)[raw.offset:raw.offset + len(raw) + 1]
                total += np.bincount(np.frombuffer(raw.buffers()[2], dtype=kind)[ends[0] // width:ends[-1] // width],
                                     minlength=vocabulary)
                yield rows(batch.column(0).slice(first, len(texts)), pa.array(np.diff(ends) // width, pa.int64()), raw,
                           pa.nulls(len(texts), counted))
        if keys is not None:
            found = np.flatnonzero(total)
            seen = [{"id": i, "n": n} for i, n in zip(found.tolist(), total[found].tolist())]
            yield rows(pa.nulls(1, keys), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([seen], counted))

    return docs.select("doc_id", "text").mapInArrow(
        ids, f"doc_id {key}, n_tokens long, ids binary, seen array<struct<id:int,n:long>>")


def shared_table(seen: DataFrame, vocabulary: int) -> Table:
    """The frequency table of all ids: task histograms, summed; at most one row per id reaches the driver."""
    rows = (seen.select(F.explode("seen").alias("c")).groupBy("c.id").agg(F.sum("c.n").alias("n"))).toPandas()
    counts = np.zeros(vocabulary, dtype=np.int64)
    counts[rows["id"].to_numpy(dtype=np.int64)] = rows["n"]
    return Table.from_counts(counts)


def save_table(spark: SparkSession, table: Table, path: str) -> None:
    """The shared table with its checksum, beside the frames."""
    rows = pd.DataFrame({"id": np.arange(len(table.freq)), "freq": table.freq.astype(np.int64), "crc": table.crc})
    spark.createDataFrame(rows, "id int, freq long, crc long").coalesce(1).write.parquet(f"{path}/table")


def load_table(spark: SparkSession, path: str) -> Table:
    """The table that the frames below ``path`` were coded with (one row per id of the vocabulary)."""
    rows = spark.read.parquet(f"{path}/table").orderBy("id").toPandas()
    table = Table(rows["freq"].to_numpy(dtype=np.int64))
    if len(rows) and int(rows["crc"].iloc[0]) != table.crc:
        raise ValueError("checksum of the table differs")
    return table


def write_files(tokens: DataFrame, path: str, table: Table, kind: str, layout: Layout = Layout()) -> None:
    """Write the rows of ``tokens`` in ascending doc_id order below ``path``.

    Null ids come first.  Files are ranges of doc_id, one per task, of about
    ``file_ids`` ids; every frame is coded on its own.
    """
    spark = tokens.sparkSession
    ship_package(spark)
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    shared = spark.sparkContext.broadcast(table)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pd.DataFrame:
            nonlocal docs, parts, held
            out = frame(docs, [len(p) for p in parts], np.concatenate(parts), shared.value, layout)
            docs, parts, held = [], [], 0
            return pd.DataFrame({"frame": [out]})

        for batch in batches:
            for doc_id, raw in zip(batch["doc_id"], batch["ids"]):
                ids = np.frombuffer(raw, dtype=kind)
                if docs and held + len(ids) > layout.frame_ids:
                    yield flush()
                docs.append(None if doc_id is None else int(doc_id))
                parts.append(ids)
                held += len(ids)
        if docs:
            yield flush()

    ordered = (tokens.repartitionByRange(max(1, -(-total // layout.file_ids)), "doc_id")
               .sortWithinPartitions("doc_id", "n_tokens", "ids"))
    framed = ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "ids").mapInPandas(pack, "frame binary")
    framed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\0").text(f"{path}/ids")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the data set at ``path``."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(load_table(spark, path))

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                before = 0
                for f in frames(content):
                    ids = f.ids(shared.value).astype("<u4")
                    ends = np.cumsum(f.lengths)
                    crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - f.lengths, ends)]
                    out = pd.DataFrame({"file": name, "doc_id": f.doc_ids, "start": before + ends - f.lengths,
                                        "n_tokens": f.lengths, "ids_crc32": crcs})
                    yield out.astype({"doc_id": "Int64"})
                    before += f.n

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/ids")
    rows = stored(files.select("path", "content").mapInPandas(
        unpack, "file string, doc_id long, start long, n_tokens long, ids_crc32 long"), "rans-read")
    # one row per file; files are ranges of doc_id, so the first id orders them
    size = rows.groupBy("file").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("nulls"),
                                    F.sum("n_tokens").alias("n"))
    size = size.select("file", F.expr("sum(n) over (order by nulls desc, first nulls first, file "
                                      "rows between unbounded preceding and current row) - n").alias("base"))
    return rows.join(size, "file").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens",
                                          "ids_crc32")


def write_corpus(docs: DataFrame, path: str, vocab_path: str, end_id: int, layout: Layout = Layout()) -> None:
    """Tokenize, fit the shared table over all ids and write table and files below ``path``."""
    spark = docs.sparkSession
    known = Encoder(vocab_path, end_id)
    rows = stored(tokenized(docs, vocab_path, end_id), "rans-ids")
    table = shared_table(rows.where("seen is not null").select("seen"), known.vocabulary)
    save_table(spark, table, path)
    write_files(rows.where("seen is null").drop("seen"), path, table, known.kind, layout)


def op2_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every whole text of ``documents`` as coded ids and read the files back.

    A null or empty text is the end id alone.  Rows of one doc_id are ordered
    by length and ids; a null doc_id comes first; an empty table gives no row.
    """
    import public_tokenizers

    path = shared_path(spark, "rans")
    docs = read_table(spark, sf_dir, "documents")
    write_corpus(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_files(spark, path)
