"""Packing into length buckets that minimise padding.

The global histogram of lengths (rounded up to ``multiple``) is the only thing
that reaches the driver: at most budget / multiple rows, as a longer document
is a batch of its own.  Dynamic programming over it chooses the bucket
boundaries with the least padding; the cost obeys the quadrangle inequality,
so each layer is solved by divide and conquer over monotone split points.
Inside a bucket documents are numbered in a pseudo-random but repeatable
order, and every budget // boundary of them form a batch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import numbered, read_table, ship_package, stored
from churnlens.llm.rans import length_udf


@dataclass(frozen=True)
class PackingConfig:
    """``budget`` padded tokens in a batch, ``buckets`` boundaries at most."""

    budget: int = 65_536
    buckets: int = 16
    multiple: int = 8


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The at most ``buckets`` boundaries with the least total padding.

    ``lengths`` ascending and distinct; a row costs its boundary minus its
    length, so only boundary * rows matters.  Among equal costs fewer buckets
    win.
    """
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    top = np.asarray(lengths, dtype=np.float64)
    best = top * rows[1:]  # one bucket for the first j + 1 lengths
    splits: list[np.ndarray] = []
    for _ in range(1, min(buckets, n)):
        prior = np.concatenate([[0.0], best])
        layer, split = best.copy(), np.full(n, -1)
        stack = [(0, n - 1, 0, n - 1)]
        while stack:
            low, high, first, last = stack.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j) + 1)
            cost = prior[i] + top[j] * (rows[j + 1] - rows[i])
            at = int(cost.argmin())
            if cost[at] < layer[j]:
                layer[j], split[j] = cost[at], i[at]
            stack.append((low, j - 1, first, int(i[at])))
            stack.append((j + 1, high, int(i[at]), last))
        if layer[-1] >= best[-1]:
            break
        best = layer
        splits.append(split)
    bounds, j = [], n - 1
    for split in reversed(splits):
        bounds.append(int(lengths[j]))
        if split[j] >= 0:
            j = int(split[j]) - 1
        else:
            bounds.pop()
        if j < 0:
            break
    if j >= 0:
        bounds.append(int(lengths[j]))
    return sorted(bounds)


def padded(n: Column, multiple: int) -> Column:
    """A length rounded up to the multiple; an empty document takes one."""
    return (F.greatest(F.ceil(n / multiple), F.lit(1)) * multiple).cast("long")


def fit_boundaries(lengths: DataFrame, cfg: PackingConfig = PackingConfig()) -> list[int]:
    """Boundaries for the global histogram of a column n_tokens."""
    rows = (lengths.select(padded(F.col("n_tokens"), cfg.multiple).alias("length")).where(F.col("length") <= cfg.budget)
            .groupBy("length").agg(F.count("*").alias("n")).orderBy("length").collect())
    return optimal_boundaries(np.array([r.length for r in rows]), np.array([r.n for r in rows]), cfg.buckets)


def pack(docs: DataFrame, vocab_path: str, cfg: PackingConfig = PackingConfig()) -> DataFrame:
    """doc_id, n_tokens, bucket, batch, slot, padding of every row.

    ``bucket`` is the padded length, ``batch`` counts from 0 inside a bucket,
    ``slot`` from 0 inside a batch.  A document whose padded length exceeds the
    budget is a batch of its own, with its own padded length as bucket.  Null
    and empty texts have no tokens and take the smallest bucket; rows with
    equal or null ids are each packed; extra columns are ignored; an empty
    table gives an empty result.
    """
    ship_package(docs.sparkSession)
    rows = stored(docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                              length_udf(vocab_path)("text").alias("n_tokens")), "packing-lengths")
    bounds = fit_boundaries(rows, cfg)
    own = padded(F.col("n_tokens"), cfg.multiple)
    fits = F.array_min(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<long>"), lambda b: b >= own))
    rows = rows.withColumn("bucket", F.when(own > cfg.budget, own).otherwise(fits))
    rows = rows.withColumn("shuffled", F.xxhash64("doc_id", "text_hash"))
    rows = numbered(rows, ["bucket"], ["shuffled", "doc_id"], "position", "packing-order")
    each = F.greatest(F.floor(F.lit(cfg.budget) / F.col("bucket")), F.lit(1)).cast("long")
    return rows.select("doc_id", "n_tokens", "bucket", F.floor(F.col("position") / each).cast("long").alias("batch"),
                       (F.col("position") % each).cast("long").alias("slot"),
                       (F.col("bucket") - F.col("n_tokens")).alias("padding"))


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of every whole text of ``documents``."""
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
