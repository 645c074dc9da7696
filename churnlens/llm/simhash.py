"""SimHash near-duplicates with a pigeonring filter.

Fingerprints (64 bit majority of XXH64 over word shingles) that differ in at
most ``max_distance`` bits are linked.  The 64 bits form a ring of
``segments`` segments.  If two fingerprints differ in d <= t bits, some
rotation of the ring has, for every l, at most l*t/segments differing bits in
its first l segments (pigeonring principle).  Where that budget is below one
bit the segments must be equal: this run of segments is the join key of the
rotation; the budgets of the longer chains prune the joined pairs before the
full Hamming check.

Work is on distinct fingerprints, so exact copies cost one aggregation row.
A key shared by more than ``bucket`` fingerprints is not paired at all:
every member is listed under each fingerprint within half the distance that
keeps the key bits (38 rows at distance 2), and members listed under the same
one are linked to the smallest.  For an even distance this is exact (balls of
half the distance meet if and only if the centres are within it), so a hot
key costs rows in proportion to its members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import connected_components, read_table, ship_package, stored

BITS = 64
SEED = 42
HASHES_AT_ONCE = 100_000


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed 64-bit SimHash of a whole text; 0 if it has no word."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII separators
    if not words:
        return 0
    shingles = (map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle
                else [b" ".join(words)])
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(partial(xxh64_intdigest, seed=SEED), shingles), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        part = hashes[at:at + HASHES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint_udf(shingle: int):
    """A vectorised text -> fingerprint function."""

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return fp


def ring(segments: int) -> list[int]:
    """Bit masks of the segments, as even as possible, lowest bits first."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _rotations(masks: list[int], t: int) -> list[int]:
    """For each rotation the mask of the leading segments that must be equal."""
    m = len(masks)
    run = max(n for n in range(m + 1) if n * t // m == 0)
    if not 1 <= run:
        raise ValueError("more segments than differing bits are needed")
    return [sum(masks[(i + j) % m] for j in range(run)) for i in range(m)]


def _chain(diff: Column, rotation: int, masks: list[int], t: int) -> Column:
    """Every chain from this rotation keeps its proportional budget."""
    m, ok, chain = len(masks), F.lit(True), 0
    for n in range(1, m + 1):
        chain |= masks[(rotation + n - 1) % m]
        if n == m or n * t // m < (n + 1) * t // m:  # between steps a longer chain implies the shorter
            ok = ok & (F.bit_count(diff.bitwiseAND(F.lit(signed(chain)))) <= n * t // m)
    return ok


def hamming_links(fps: DataFrame, max_distance: int = 2, segments: int = 7, bucket: int = 64) -> DataFrame:
    """Links (u, v) that connect exactly what pairs within the distance connect.

    ``fps``: one long column fp, distinct.  Up to ``bucket`` fingerprints
    under a key give all their pairs within the distance; larger buckets give
    star links with the same connected components.
    """
    t, masks = max_distance, ring(segments)
    if t % 2:
        raise ValueError("max_distance must be even")
    runs = _rotations(masks, t) if t else [(1 << BITS) - 1]
    keyed = fps.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(signed(r))) for r in runs])).alias("rotation", "key"))
    sizes = keyed.groupBy("rotation", "key").agg(F.count("*").alias("n")).where("n > 1")
    keyed = keyed.join(sizes, ["rotation", "key"])

    few = keyed.where(F.col("n") <= bucket).groupBy("rotation", "key").agg(F.sort_array(F.collect_list("fp")).alias("a"))
    pairs = (few.select("rotation", "a", F.posexplode("a").alias("i", "u"))
             .select("rotation", "u", F.explode(F.expr("slice(a, i + 2, size(a))")).alias("v")))
    diff = F.col("u").bitwiseXOR(F.col("v"))
    by_rotation = F.lit(False)
    for i in range(len(runs)):
        by_rotation = F.when(F.col("rotation") == i, _chain(diff, i, masks, t)).otherwise(by_rotation)
    pairs = pairs.where(by_rotation).where(F.bit_count(diff) <= t).select("u", "v")

    near = F.lit(None).cast("array<long>")
    for i, r in enumerate(runs):
        free = [1 << b for b in range(BITS) if not r >> b & 1]
        flips = [sum(c) for k in range(t // 2 + 1) for c in combinations(free, k)]
        near = F.when(F.col("rotation") == i, F.array(*[F.lit(signed(f)) for f in flips])).otherwise(near)
    listed = (keyed.where(F.col("n") > bucket).select("rotation", "fp", F.explode(near).alias("flip"))
              .select("rotation", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"))
              .groupBy("rotation", "near").agg(F.collect_list("fp").alias("a")).where(F.size("a") > 1))
    stars = listed.select(F.array_min("a").alias("u"), F.explode("a").alias("v")).where("u <> v")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, segments: int = 7,
                    bucket: int = 64) -> DataFrame:
    """doc_id, text_hash, fingerprint (16 hex digits), component_id of every row.

    component_id is the smallest doc_id reachable over links.  Texts without
    a word (null, empty) have fingerprint 0 and link like others.  A row with
    a null doc_id links others but names no component (a component of such
    rows only has a null id).  Repeated rows repeat; ties need no order, as
    the smallest id is unique; extra columns are ignored; an empty table
    gives an empty result.
    """
    ship_package(docs.sparkSession)
    fps = stored(docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                             fingerprint_udf(shingle)("text").alias("fp")), "simhash")
    firsts = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    links = hamming_links(firsts.select("fp"), max_distance, segments, bucket)
    roots = connected_components(links, "simhash-components")
    rooted = firsts.join(roots, firsts.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, the smallest id.

    All columns are returned as they came.  Rows with a null doc_id cannot be
    told apart and stay.  If the smallest id occurs in several rows of a
    group, one of them stays.
    """
    named = near_duplicates(docs, **how)
    stay = (named.where("doc_id = component_id").groupBy("doc_id", "text_hash")
            .agg(F.count("*").alias("n"), F.min("fingerprint").alias("fp"))
            .withColumn("rank", F.expr("row_number() over (partition by doc_id, fp order by text_hash)"))
            .where("rank = 1"))
    stay = stored(stay.select(F.col("doc_id").alias("_stay_id"), F.col("text_hash").alias("_stay_hash"),
                              F.col("n").alias("_stay_n")), "simhash-stay")
    at = (F.col("_doc.doc_id") == F.col("_stay_id")) & (F.xxhash64(F.col("_doc.text")) == F.col("_stay_hash"))
    columns = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns]
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    once = inner.join(stay.where("_stay_n = 1"), at, "left_semi").select(columns)
    again = (inner.join(stay.where("_stay_n > 1"), at, "inner")
             .groupBy("_stay_id", "_stay_hash").agg(F.first("_doc").alias("_doc")).select(columns))
    return once.union(again).union(docs.where("doc_id is null"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of every whole text of ``documents``."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_hash")
