"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut where a separator run begins and around single line ends (the
byte-level pre-tokenizer never joins characters across such places), each
piece is split by the pre-tokenizer's pattern, and every pre-token starts as a
linked list of its bytes.  A heap holds the ranks of adjacent pairs; the lowest rank (leftmost
first) is popped and merged until no pair has a rank.  The count of a
pre-token is its bytes minus its merges; no identifiers are produced.

Counts of pieces and of pre-tokens are kept in bounded two-generation caches
per Python worker; a cache only saves time, never changes a count.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Collection, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import read_table, ship_package

# Twice as many are held (two generations), about 160 bytes each, per worker.
PIECES_CACHED = 300_000
WORDS_CACHED = 100_000
LONGEST_CACHED = 64
TEXTS_AT_ONCE = 2_000
CHARACTERS_AT_ONCE = 8_000_000

# The characters with the Unicode property White_Space, which is
# what the pre-tokenizer's \\s means (Python's own \\s has four more).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


# A text that holds one of these is cut by RUNS; all others have words parted by
# one space or one line end each, and are cut by Arrow's string functions.
FIRST = "\x01"
ODD = (r"[ \n][ \n]|^[ \n]|[ \n]$|^$|[\x01\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def portions(texts: Sequence[str | None]) -> Iterator[tuple[int, Sequence[str | None]]]:
    """The texts in runs of bounded number and size, with the place of the first."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if i + 1 - first == TEXTS_AT_ONCE or size >= CHARACTERS_AT_ONCE:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def cut(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, list[str], np.ndarray, np.ndarray]]:
    """Texts cut into pieces that the pre-tokenizer treats independently.

    A piece is a separator run with the word after it.  Yields groups of texts
    as (their places in ``texts``, distinct pieces, index of every piece in
    order, end of each text in the index).
    """
    array = pa.array(["" if t is None else t for t in texts], pa.large_string())
    odd = pc.match_substring_regex(array, ODD).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(~odd)
    if len(at):
        spaced = pc.replace_substring(array.take(pa.array(at)), "\n", " \n")
        mark, nothing = (pa.scalar(x, pa.large_string()) for x in (FIRST, ""))
        lists = pc.split_pattern(pc.binary_join_element_wise(mark, spaced, nothing), " ")
        words = lists.flatten().dictionary_encode()
        pieces = [w[1:] if w[0] == FIRST else w if w[0] == "\n" else " " + w for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()]
        yield at, pieces, words.indices.to_numpy(), lists.offsets.to_numpy()[1:].astype(np.int64)
    at = np.flatnonzero(odd)
    if len(at):
        place: dict[str, int] = {}
        found = [[place.setdefault(p, len(place)) for p in RUNS.findall(texts[i] or "")] for i in at]
        yield at, list(place), np.array([k for x in found for k in x], dtype=np.int64), np.cumsum([len(x) for x in found])


class GenerationCache(dict):
    """Bounded memo: ``make`` fills misses; the older half is dropped when full."""

    def __init__(self, make, entries: int):
        super().__init__()
        self.make, self.entries, self.old = make, entries, {}

    def lookup(self, keys: Collection) -> dict:
        """What is known of ``keys``; nothing is made."""
        get, old = self.get, self.old.get
        found = {k: v for k in keys if (v := get(k)) is not None}
        if self.old and len(found) < len(keys):
            again = {k: v for k in keys if k not in found and (v := old(k)) is not None}
            self.store(again)
            found |= again
        return found

    def store(self, items: dict) -> None:
        if len(self) + len(items) > self.entries:
            self.old = dict(self)
            self.clear()
        self.update((k, v) for k, v in items.items() if len(k) <= LONGEST_CACHED)

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.store({key: value})
        return value


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies use for each byte."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(moved)}


def merges_left(symbols: bytes, ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Symbols left after merging: initial bytes minus merges done."""
    n = len(symbols)
    if n < 2:
        return n
    part: list[bytes | None] = [symbols[i:i + 1] for i in range(n)]
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((part[i], part[i + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if part[i] is not None else -1
        if j < 0 or ranks.get((part[i], part[j])) != rank:
            continue  # one side has been merged away or has grown since
        part[i] += part[j]
        part[j] = None
        left -= 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if (r := ranks.get((part[i], part[k]))) is not None:
                heapq.heappush(heap, (r, i))
        h = before[i]
        if h >= 0 and (r := ranks.get((part[h], part[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return left


class ByteBpeCounter:
    """Counts tokens as the tokenizer file's byte-level BPE gives them."""

    def __init__(self, vocab_path: str):
        import public_tokenizers
        import regex

        with open(vocab_path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        raw = lambda s: bytes(alphabet[c] for c in s)
        self.ranks = {(raw(a), raw(b)): r for r, (a, b) in enumerate(
            m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        self.words = GenerationCache(lambda w: merges_left(w.encode(), self.ranks), WORDS_CACHED)
        self.pieces = GenerationCache(self._piece, PIECES_CACHED)

    def _plain(self, text: str) -> int:
        words = self.words
        return sum(words[w] for w in self.pattern.findall(text))

    def _piece(self, text: str) -> int:
        if not any(s in text for s in self.specials):
            return self._plain(text)
        parts = self.special.split(text)  # specials stand at odd places
        return sum(map(self._plain, parts[::2])) + len(parts) // 2

    def counts(self, texts: Sequence[str | None]) -> np.ndarray:
        """Tokens of each whole text (null: 0)."""
        out = np.zeros(len(texts), dtype=np.int64)
        for first, some in portions(texts):
            for at, pieces, index, ends in cut(some):
                each = np.fromiter(map(self.pieces.__getitem__, pieces), dtype=np.int64, count=len(pieces))
                upto = np.concatenate([[0], np.cumsum(each[index])])
                out[first + at] = upto[ends] - upto[np.concatenate([[0], ends[:-1]])]
        return out


@lru_cache(maxsize=4)
def counter(vocab_path: str) -> ByteBpeCounter:
    """One counter per Python worker and vocabulary."""
    return ByteBpeCounter(vocab_path)


def token_count_udf(vocab_path: str):
    """A vectorised text -> token count function (null counts as empty)."""

    @F.pandas_udf("long")
    def n_tokens(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(vocab_path)
        for batch in texts:
            yield pd.Series(count.counts(batch.tolist()), dtype="int64")

    return n_tokens


def count_tokens(docs: DataFrame, vocab_path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row.

    Map-only: nothing is shuffled.  A null or empty text has 0 bytes and 0
    tokens; repeated rows give repeated results; a null doc_id stays null;
    other columns are ignored; an empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        token_count_udf(vocab_path)("text").alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text of ``documents``."""
    import public_tokenizers

    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
