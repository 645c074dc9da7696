"""Benchmark decontamination by SimHash windows (DataFrame functions only).

Texts and benchmark items become sequences of shingle hashes (five lower-cased
words of letters and digits; an item of fewer words is one shingle).  For each
item, windows of its number of words slide over every text that shares a
shingle with it; only windows that hold such a shingle are formed, as any other
window has similarity zero.  A text shorter than the item is one window of its
own.  A window's SimHash is cut into radius + 1 blocks; of two fingerprints
within the radius at least one block is equal, so a join on (item, block,
value) finds them all.  Windows, not texts or items, grow with the input: what
is joined per window is its fingerprint, and hashes are fetched again only for
the candidates within the radius.  These are verified by their exact weighted
Jaccard similarity, shingles weighing as often as they occur.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import read_table, stored

BITS = 64
NARROW, WIDE = 16, 32  # bits of a counter: bit b is counted in sum b % bits, lane b // bits

# Shingles of items that a pass over the texts looks for (expected number).
SHINGLES_AT_ONCE = 50_000

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(hashes: Column, k: int) -> Column:
    """Hashes of all runs of k words, from the word hashes."""
    made = F.transform(F.sequence(F.lit(0), F.size(hashes) - k),
                       lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))
    return F.when(F.size(hashes) >= k, made).otherwise(F.array().cast("array<long>"))


def blocks(radius: int) -> list[int]:
    """Masks of radius + 1 blocks of the fingerprint."""
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return [signed((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]


def majority(window: str) -> Column:
    """SimHash of an array column of hashes: bits set in more than half of them.

    Sixteen sums count four bits each, so one pass over the array serves all
    64 bits; where 16-bit counters could overflow, 32 sums count two bits each.
    """
    def counted(width: int) -> str:
        lanes = sum(1 << k for k in range(0, BITS, width))
        shifts = ", ".join(map(str, range(width)))
        sums = (f"aggregate({window}, array_repeat(0L, {width}), (acc, h) -> zip_with(acc, array({shifts}), "
                f"(a, j) -> a + (shiftrightunsigned(h, j) & {lanes}L)))")
        bits = " | ".join(f"if(2 * (shiftrightunsigned(s[{b % width}], {b // width * width}) & {(1 << width) - 1}L) > "
                          f"size({window}), shiftleft(1L, {b}), 0L)" for b in range(BITS))
        return f"transform(array({sums}), s -> {bits})[0]"

    return F.expr(f"if(size({window}) < {1 << NARROW}, {counted(NARROW)}, {counted(WIDE)})")


def items_of(benchmark: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """item_id, n (words), m (shingles), k (words in a shingle), h, fp; items without a word are left out.

    Equal rows are one item; a null item_id is an item of its own.
    """
    df = (benchmark.select("item_id", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("w")).distinct()
          .where(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(shingle))))
    h = reduce(lambda rest, k: F.when(F.col("k") == k, shingles(F.col("w"), k)).otherwise(rest),
               range(1, shingle + 1), F.lit(None).cast("array<long>"))
    df = df.select(F.xxhash64("item_id", "w").alias("item"), "item_id", F.size("w").alias("n"), "k", h.alias("h"))
    return df.withColumn("m", F.size("h")).withColumn("fp", majority("h"))


def once(column: Column, name: str) -> Column:
    """The column computed once per row.

    A generator of one element: the optimizer moves filters below projections
    by copying their expressions, also into loops over an array, but leaves
    generators alone.
    """
    return F.explode(F.array(column)).alias(name)


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("key_a"), F.xxhash64(F.lit("second"), t).alias("key_b")]


def _sharing(docs: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """key_a, key_b, h (all shingle hashes) of the distinct texts that share a shingle with an item.

    The items' shingles are looked for as literals, in passes of about
    ``SHINGLES_AT_ONCE``, so that a text's hashes are tested where they are made.
    """
    rows = docs.select(*text_key(F.col("text")),
                       once(F.transform(words(F.col("text")), lambda w: F.xxhash64(w)), "w"))
    rows = rows.select("key_a", "key_b", once(shingles(F.col("w"), k), "h"))
    known = index.select("s").distinct()
    passes = max(1, -(-known.count() // SHINGLES_AT_ONCE))
    found = rows.limit(0)
    for i in range(passes):
        few = [r.s for r in known.where(F.pmod("s", F.lit(passes)) == i).collect()]
        if few:
            found = found.union(rows.where(f"exists(h, x -> x in ({', '.join(f'{s}L' for s in few)}))"))
    return found.groupBy("key_a", "key_b").agg(F.first("h").alias("h"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
                       similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """key_a, key_b, item_id, start_word, n_words, hamming, similarity: each text's best window per item."""
    items = stored(items_of(benchmark, shingle), "decontaminate-items")
    sizes = [r.k for r in items.select("k").distinct().collect()]  # at most `shingle` values
    masks = blocks(radius)
    block = F.explode(F.expr("array(" + ", ".join(f"named_struct('block', {b}, 'value', fp & {m}L)"
                                                  for b, m in enumerate(masks)) + ")")).alias("b")
    found = []
    text = ["key_a", "key_b"]
    for k in sorted(sizes):
        own = items.where(F.col("k") == k)
        index = own.select("item", "m", F.explode("h").alias("s")).distinct()
        texts = stored(_sharing(docs, index, k), "decontaminate-texts")
        hits = (texts.select(*text, F.size("h").alias("size"), F.posexplode("h").alias("at", "s"))
                .join(index, "s").groupBy(*text, "size", "item", "m")
                .agg(F.collect_set("at").alias("at"))  # bounded by one text's length
                .where(F.col("size") >= similarity * F.col("m") - 1e-6))  # a similarity is at most size / m
        starts = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(
            F.greatest(p - F.col("m") + 1, F.lit(0)), F.greatest(F.least(p, F.col("size") - F.col("m")), F.lit(0))))))
        starts = hits.select(*text, "item", "m", F.explode(starts).alias("start"))  # 0 if size < m
        windows = starts.join(texts, text).select(*text, "item", "start", once(F.expr("slice(h, start + 1, m)"), "window"))
        windows = windows.select(*text, "item", "start", once(majority("window"), "fp"))
        near = windows.select(*text, "item", "start", "fp", block).select(*text, "item", "start", "fp", "b.*")
        probe = own.select("item", F.col("fp").alias("item_fp"), "fp", block).select("item", "item_fp", "b.*")
        diff = F.expr("fp ^ item_fp")
        first_equal = F.expr("coalesce(" + ", ".join(f"if((fp ^ item_fp) & {m}L = 0, {b}, null)"
                                                     for b, m in enumerate(masks)) + ")")
        near = (near.join(probe, ["item", "block", "value"]).where(F.bit_count(diff) <= radius)
                .where(first_equal == F.col("block"))  # of several equal blocks one counts
                .select(*text, "item", "start", F.bit_count(diff).alias("hamming")))
        near = stored(near, "decontaminate-near")
        near = (near.join(texts, text).join(own.select("item", "item_id", "m", F.col("h").alias("item_h")), "item")
                .select(*text, "item_id", "m", "item_h", "start", "hamming", once(F.expr("slice(h, start + 1, m)"), "window")))
        plain = (F.size(F.array_distinct("window")) == F.size("window")) & \
            (F.size(F.array_distinct("item_h")) == F.size("item_h"))
        count = lambda a, x: F.size(F.filter(a, lambda y: y == x))
        shared = F.when(plain, F.size(F.array_intersect("window", "item_h"))).otherwise(F.aggregate(
            F.array_distinct("item_h"), F.lit(0), lambda a, x: a + F.least(count(F.col("window"), x), count(F.col("item_h"), x))))
        near = near.select("*", once(shared, "shared")).withColumn(
            "similarity", F.col("shared") / (F.size("window") + F.col("m") - F.col("shared"))).where(F.col("similarity") >= similarity)
        found.append(near.groupBy(*text, "item_id").agg(
            F.max(F.struct("similarity", (-F.col("start")).alias("back"), (F.size("window") + k - 1).alias("n_words"),
                           (-F.col("hamming")).alias("near"))).alias("best")))
    if not found:
        return docs.where(F.lit(False)).select(
            *text_key(F.col("text")), F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("start_word"),
            F.lit(0).alias("n_words"), F.lit(0).alias("hamming"), F.lit(0.0).alias("similarity"))
    best = reduce(DataFrame.union, found).groupBy("key_a", "key_b", "item_id").agg(F.max("best").alias("best"))
    return best.select("key_a", "key_b", "item_id", (-F.col("best.back")).alias("start_word"),
                       F.col("best.n_words").alias("n_words"), (-F.col("best.near")).alias("hamming"),
                       F.col("best.similarity").alias("similarity"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """doc_id, item_id, start_word, n_words, hamming, similarity of every document and item it leaks.

    One row per row of ``docs`` and leaked item: the most similar window, the
    earliest among equals.  ``n_words`` counts the window's words: the item's,
    or all of a text that has fewer.  Null and empty texts leak nothing; a null doc_id
    is reported as null; repeated rows repeat; extra columns are ignored;
    an empty table on either side gives an empty result.
    """
    found = stored(contaminated_texts(docs, benchmark, **how), "decontaminate-found")
    ids = docs.select("doc_id", *text_key(F.col("text")))
    return ids.join(found, ["key_a", "key_b"]).drop("key_a", "key_b")


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns as they came."""
    found = stored(contaminated_texts(docs, benchmark, **how).select("key_a", "key_b").distinct(), "decontaminate-keys")
    found = found.select(F.col("key_a").alias("_leak_a"), F.col("key_b").alias("_leak_b"))
    a, b = text_key(F.col("_doc.text"))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    rest = inner.join(found, (a == F.col("_leak_a")) & (b == F.col("_leak_b")), "left_anti")
    return rest.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])


def op8_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks of every item of ``benchmark`` in every whole text of ``documents``."""
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("hamming")


OP8_SQL = r"""
WITH iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
            FROM benchmark),
     i AS (SELECT item_id, w, CAST(len(w) AS INTEGER) AS n, least(len(w), 5) AS k, len(w) - least(len(w), 5) + 1 AS m
           FROM iw WHERE len(w) > 0),
     ish AS (SELECT item_id, n, k, m, s, count(*) AS c
             FROM (SELECT item_id, n, k, m, list_slice(w, p, p + k - 1) AS s
                   FROM (SELECT *, unnest(range(1, m + 1)) AS p FROM i)) GROUP BY ALL),
     d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
           FROM documents),
     ks AS (SELECT DISTINCT k FROM i),
     dsh AS (SELECT doc_id, k, size, p, list_slice(w, p, p + k - 1) AS s
             FROM (SELECT doc_id, w, k, len(w) - k + 1 AS size, unnest(range(1, len(w) - k + 2)) AS p
                   FROM d, ks WHERE len(w) >= k)),
     hits AS (SELECT doc_id, item_id, p, size, dsh.s, n, m, c, ish.k FROM dsh JOIN ish ON ish.k = dsh.k AND ish.s = dsh.s),
     -- a text of fewer shingles than the item is one window: start 1, size shingles, all its words
     starts AS (SELECT DISTINCT doc_id, item_id, m, least(size, m) AS held, CAST(if(size < m, size + k - 1, n) AS INTEGER) AS n,
                       unnest(range(greatest(p - m + 1, 1), greatest(least(p, size - m + 1), 1) + 1)) AS start FROM hits),
     o AS (SELECT st.doc_id, st.item_id, st.n, st.m, st.held, st.start, h.s, least(count(*), any_value(h.c)) AS c
           FROM starts st JOIN hits h ON h.doc_id = st.doc_id AND h.item_id = st.item_id
                AND h.p >= st.start AND h.p < st.start + st.m GROUP BY st.doc_id, st.item_id, st.n, st.m, st.held, st.start, h.s),
     j AS (SELECT doc_id, item_id, n, start, sum(c) / (any_value(held) + any_value(m) - sum(c)) AS similarity
           FROM o GROUP BY doc_id, item_id, n, start)
SELECT doc_id, item_id, CAST(arg_min(start, (-similarity, start)) - 1 AS INTEGER) AS start_word, n AS n_words, max(similarity) AS similarity
FROM j WHERE similarity >= 0.8 GROUP BY doc_id, item_id, n
"""
