"""Labelled rows for the classifiers of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 1 << 31


def fold_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: decides which labels are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
                   bound: int) -> DataFrame:
    """(text, label, fold) of about ``bound`` labelled documents at most.

    Labels of held-out ids are never read.  If more labels than ``bound``
    remain, ids are kept by a hash threshold of bound / count, so the expected
    size is the bound whatever the input's size; that makes the broadcast of
    the chosen labels safe.  Several labels of one id count as their largest.
    Equal texts are used once.  fold (0-4) is a hash of the text.
    """
    known = (labels.select(F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("label"))
             .where("label_id is not null and label in (0, 1)")
             .where(F.coalesce(fold_of(F.col("label_id"), modulus) != held_out, F.lit(False)))
             .groupBy("label_id").agg(F.max("label").alias("label")))
    n = known.count()
    if n > bound:
        known = known.where(F.pmod(F.xxhash64("label_id"), F.lit(HASH_RANGE)) < int(HASH_RANGE * (bound / n)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return (texts.join(F.broadcast(known), texts.doc_id == known.label_id)
            .groupBy(F.xxhash64("text").alias("text_hash"), F.length("text").alias("n"))
            .agg(F.first("text").alias("text"), F.max("label").alias("label"))
            .select("text", "label", F.pmod("text_hash", F.lit(5)).cast("int").alias("fold")))
