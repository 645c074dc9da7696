"""Ranked lexical search by pipelined term partitioning.

The terms of the items are dealt to a few owners, the rarest first, with equal
numbers of postings.  Documents are cut into slices of bounded size.  A bundle
of items, with a sparse accumulator per item over one slice, visits the owners
one after the other: at every owner it is cogrouped with that owner's postings
of the slice and adds their integer contributions.  The last owner picks each
item's best documents of the slice; two window steps pick the best of all.

Before it goes on, a bundle leaves behind the accumulators that even the
greatest contributions still to come could not lift to the score that ``top``
documents of the slice have already; that loses no result.

A cogroup holds one slice and one bundle, so no group grows with the table, and
a frequent term is spread over all slices.  Items are taken in blocks of
bounded numbers of terms, each block in one pass over the texts; only a block's
terms and their document frequencies are ever on the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens.llm.common import read_table, shared_path, ship_package, stored

# A-Z become lower case, every other byte outside 0-9, a-z and 0x80-0xFF parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SALTS = 256


@dataclass(frozen=True)
class SearchConfig:
    """``top`` documents per item; the sizes of blocks, bundles and slices change no result."""

    top: int = 50
    owners: int = 4
    block_terms: int = 100_000  # (item, term) pairs in a block, expected
    bundle_items: int = 256
    slice_docs: int = 4_096
    slice_postings: int = 1 << 18


def terms(raw: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return (raw or b"").translate(TERM_BYTES).split()


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term as bytes); all rows of one item_id are one item, null is an id like any other."""
    ship_package(items.sparkSession)
    key = items.schema["item_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms(r))) for r in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))],
                                             names=["item_id", "terms"])

    rows = items.select("item_id", "text").mapInArrow(work, f"item_id {key}, terms array<binary>")
    return rows.select("item_id", F.explode("terms").alias("term")).distinct()


SLICE = ("slice long, seen long, total long, ids array<long>, sizes array<long>, "
         "doc array<int>, term array<int>, tf array<long>")


def slices(docs: DataFrame, vocabulary: dict[bytes, int], cfg: SearchConfig) -> DataFrame:
    """Postings of the vocabulary's terms by slice of documents.

    ``seen`` counts all documents with a term and ``total`` all terms since
    the task's previous slice; ``ids`` and ``sizes`` (terms) list the
    documents that hold a term of the vocabulary, ``doc`` points into them.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, made = shared.value.get, TaskContext.get().partitionId() << 32
        seen = total = 0
        ids, sizes, doc, term, tf = [], [], [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal seen, total, made, ids, sizes, doc, term, tf
            longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
            out = pa.RecordBatch.from_arrays(
                [pa.array([made], pa.int64()), pa.array([seen], pa.int64()), pa.array([total], pa.int64()),
                 pa.array([ids], longs), pa.array([sizes], longs), pa.array([doc], ints), pa.array([term], ints),
                 pa.array([tf], longs)], names=["slice", "seen", "total", "ids", "sizes", "doc", "term", "tf"])
            made, seen, total, ids, sizes, doc, term, tf = made + 1, 0, 0, [], [], [], [], []
            return out

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                words = terms(raw)
                seen, total = seen + bool(words), total + len(words)
                known = Counter(map(number, words))
                known.pop(None, None)
                if known:
                    doc += [len(ids)] * len(known)
                    term += known.keys()
                    tf += known.values()
                    ids.append(doc_id)
                    sizes.append(len(words))
                    if len(ids) >= cfg.slice_docs or len(doc) >= cfg.slice_postings:
                        yield flush()
        yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, SLICE)


@dataclass
class Plan:
    """What every owner knows of a block: weights and owners of terms, the items of each bundle with their terms."""

    weight: np.ndarray
    owner: np.ndarray
    bundles: list[list[np.ndarray]]
    n_docs: int
    n_terms: int
    cfg: SearchConfig

    def pairs(self, bundle: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of the item in the bundle, term) of all its items."""
        items = self.bundles[bundle]
        return np.repeat(np.arange(len(items)), [len(t) for t in items]), np.concatenate(items)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gains(weight: np.ndarray, tf: np.ndarray, size: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one term adds to the score of one document."""
    m = 100 - 50 + (50 * size * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def owners_of(df: np.ndarray, owners: int) -> np.ndarray:
    """Owner of each term: rarest first, equal shares of all postings."""
    order = np.argsort(df, kind="stable")
    before = np.cumsum(df[order]) - df[order]
    out = np.zeros(len(df), dtype=np.int64)
    out[order] = np.minimum(before * owners // max(int(df.sum()), 1), owners - 1)
    return out


def numbers(rows: pa.RecordBatch | pa.Table, name: str, row: int = 0) -> np.ndarray:
    """The array in one row of a list column; nothing if there is no such row."""
    if not rows.num_rows:
        return np.zeros(0, dtype=np.int64)
    return rows.column(name)[row].values.to_numpy(zero_copy_only=False)


SHARD = "slice long, bundle int, owner int, doc array<int>, term array<int>, gain array<long>, rest array<long>, ids array<long>"


def shards(rows: DataFrame, plan: Plan) -> DataFrame:
    """The owners' postings of every slice and bundle.

    ``rest`` is, per item, the most that later owners can add to any document
    of the slice; the last owner also gets the documents' ids.
    """
    shared = rows.sparkSession.sparkContext.broadcast(plan)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        last = plan.cfg.owners - 1
        wanted = []
        for b in range(len(plan.bundles)):
            mask = np.zeros(len(plan.weight), dtype=bool)
            mask[plan.pairs(b)[1]] = True
            wanted.append(mask)
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        for batch in batches:
            for row in range(batch.num_rows):
                doc, term, tf, sizes = (numbers(batch, c, row) for c in ("doc", "term", "tf", "sizes"))
                gain = gains(plan.weight[term], tf, sizes[doc], plan.n_docs, plan.n_terms) if len(doc) else tf
                for b in range(len(plan.bundles)):
                    here = np.flatnonzero(wanted[b][term])
                    if not len(here):
                        continue
                    most = np.zeros(len(plan.weight), dtype=np.int64)
                    np.maximum.at(most, term[here], gain[here])
                    item, t = plan.pairs(b)
                    for o in range(plan.cfg.owners):
                        mine = here[plan.owner[term[here]] == o]
                        if not len(mine) and o < last:
                            continue
                        rest = np.zeros(len(plan.bundles[b]), dtype=np.int64)
                        later = plan.owner[t] > o
                        np.add.at(rest, item[later], most[t[later]])
                        ids = batch.column("ids")[row].as_py() if o == last else []
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("slice")[row:row + 1], pa.array([b], pa.int32()), pa.array([o], pa.int32()),
                             pa.array([doc[mine]], ints), pa.array([term[mine]], ints), pa.array([gain[mine]], longs),
                             pa.array([rest], longs), pa.array([ids], longs)],
                            names=["slice", "bundle", "owner", "doc", "term", "gain", "rest", "ids"])

    return rows.select("slice", "ids", "sizes", "doc", "term", "tf").mapInArrow(work, SHARD)


def accumulated(plan: Plan, owner: int, bundle: int, carried: pa.Table, own: pa.Table) -> np.ndarray:
    """Scores (item of the bundle x document of the slice) after an owner has added its contributions."""
    item, doc, score = (numbers(carried, c) for c in ("item", "doc", "score"))
    mine, term, gain = (numbers(own, c) for c in ("doc", "term", "gain"))
    width = 1 + max(int(doc.max(initial=-1)), int(mine.max(initial=-1)))
    scores = np.zeros((len(plan.bundles[bundle]), width), dtype=np.int64)
    scores[item, doc] = score
    order = np.argsort(term, kind="stable")
    mine, term, gain = mine[order], term[order], gain[order]
    for i, wanted in enumerate(plan.bundles[bundle]):
        wanted = wanted[plan.owner[wanted] == owner]
        for a, b in zip(np.searchsorted(term, wanted), np.searchsorted(term, wanted, side="right")):
            scores[i, mine[a:b]] += gain[a:b]
    return scores


CARRIED = "slice long, bundle int, item array<int>, doc array<int>, score array<long>"
BEST = "slice long, item int, doc_id long, score long"


def visit(shared, owner: int):
    """The cogroup function of one owner but the last: add, leave hopeless accumulators, pass on."""

    def step(key: tuple, carried: pa.Table, own: pa.Table) -> pa.Table:
        plan, bundle = shared.value, key[1].as_py()
        scores = accumulated(plan, owner, bundle, carried, own)
        keep = scores > 0
        if own.num_rows and scores.shape[1] > plan.cfg.top:
            rest = numbers(own, "rest")
            sure = -np.partition(-scores, plan.cfg.top - 1, axis=1)[:, plan.cfg.top - 1]
            keep &= scores + rest[:, None] >= sure[:, None]
        item, doc = np.nonzero(keep)
        ints = pa.list_(pa.int32())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "bundle": pa.array([bundle], pa.int32()),
                         "item": pa.array([item], ints), "doc": pa.array([doc], ints),
                         "score": pa.array([scores[item, doc]], pa.list_(pa.int64()))})

    return step


def select(shared, owner: int):
    """The cogroup function of the last owner: add, then each item's best documents of the slice."""

    def step(key: tuple, carried: pa.Table, own: pa.Table) -> pa.Table:
        plan, bundle = shared.value, key[1].as_py()
        scores = accumulated(plan, owner, bundle, carried, own)
        ids = own.column("ids")[0].values
        known = ids.is_valid().to_numpy(zero_copy_only=False)[:scores.shape[1]]
        number = ids.fill_null(0).to_numpy()[:scores.shape[1]]
        items, docs = [], []
        for i in range(len(scores)):
            found = np.flatnonzero(scores[i])
            order = np.lexsort((number[found], ~known[found], -scores[i, found]))[:plan.cfg.top]
            docs.append(found[order])
            items.append(np.full(len(order), i))
        item, doc = np.concatenate(items), np.concatenate(docs)
        return pa.table({"slice": pa.array(np.full(len(item), key[0].as_py()), pa.int64()),
                         "item": pa.array(item + bundle * plan.cfg.bundle_items, pa.int32()),
                         "doc_id": pa.array(number[doc], pa.int64(), mask=~known[doc]),
                         "score": pa.array(scores[item, doc], pa.int64())})

    return step


def _search_block(docs: DataFrame, wanted: list[tuple], cfg: SearchConfig) -> DataFrame:
    """item (place in ``wanted``), rank, doc_id, score for the (item_id, terms) of one block."""
    spark = docs.sparkSession
    known = sorted({t for _, ts in wanted for t in ts})
    number = {t: i for i, t in enumerate(known)}
    rows = stored(slices(docs, number, cfg), "search-slices")
    sums = rows.agg(F.sum("seen").alias("n"), F.sum("total").alias("l")).first()
    df = np.zeros(len(known), dtype=np.int64)
    for r in rows.select(F.explode("term").alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect():
        df[r.t] = r.n
    n_docs, n_terms = int(sums.n or 0), max(int(sums.l or 0), 1)
    items = [np.array(sorted(number[t] for t in ts), dtype=np.int64) for _, ts in wanted]
    plan = Plan(np.array([term_weight(n_docs, int(n)) for n in df], dtype=np.int64), owners_of(df, cfg.owners),
                [items[i:i + cfg.bundle_items] for i in range(0, len(items), cfg.bundle_items)], n_docs, n_terms, cfg)
    shared = spark.sparkContext.broadcast(plan)
    path = shared_path(spark, "search-shards")
    shards(rows, plan).write.option("compression", "zstd").partitionBy("owner").parquet(path)
    parts = spark.read.schema(SHARD).parquet(path)
    by = ["slice", "bundle"]
    carried = spark.createDataFrame([], CARRIED)
    for o in range(cfg.owners - 1):
        own = parts.where(F.col("owner") == o).select("slice", "bundle", "doc", "term", "gain", "rest")
        carried = carried.groupBy(*by).cogroup(own.groupBy(*by)).applyInArrow(visit(shared, o), CARRIED)
    own = parts.where(F.col("owner") == cfg.owners - 1).select("slice", "bundle", "doc", "term", "gain", "ids")
    best = carried.groupBy(*by).cogroup(own.groupBy(*by)).applyInArrow(select(shared, cfg.owners - 1), BEST)
    best = best.withColumn("salt", F.pmod(F.xxhash64("slice"), F.lit(SALTS)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for group in (["item", "salt"], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        best = best.where(F.col("rank") <= cfg.top)
    return best.select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, cfg: SearchConfig = SearchConfig()) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` best documents with a score above 0.

    Terms are runs of ASCII letters (case ignored), digits and characters
    beyond ASCII.  Equal scores rank by ascending doc_id (a whole number),
    null last.  Every row of ``docs`` is a document, equal ids or not; rows of
    one item_id (null too) are one item.  Null and empty texts have no terms;
    items without a term, or whose terms occur nowhere, have no rows; extra
    columns are ignored; an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    pairs = stored(item_terms(items), "search-items")
    blocks = max(1, -(-pairs.count() // cfg.block_terms))
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for b in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        wanted = [(r.item_id, [bytes(t) for t in r.terms])
                  for r in mine.groupBy("item_id").agg(F.collect_set("term").alias("terms")).collect()]
        if not wanted:
            continue
        names = spark.createDataFrame([(i, w[0]) for i, w in enumerate(wanted)], f"item int, item_id {kind}")
        found = _search_block(docs, wanted, cfg).join(F.broadcast(names), "item")  # names: the items of one block
        out = out.union(found.select("item_id", "rank", "doc_id", "score"))
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all ``documents`` for every item of ``benchmark``."""
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
     i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     s AS (SELECT count(*) FILTER (len(t) > 0) AS big_n, sum(len(t)) AS big_l FROM d),
     tf AS (SELECT r, doc_id, n, term, count(*) AS tf
            FROM (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d)
            WHERE term IN (SELECT term FROM i) GROUP BY r, doc_id, n, term),
     w AS (SELECT term, CAST(floor(1000 * ln((2 * CAST(any_value(big_n) AS DOUBLE) + 2) / (2 * CAST(count(*) AS DOUBLE) + 1))) AS BIGINT) AS w
           FROM tf, s GROUP BY term),
     g AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * CAST(big_n AS BIGINT)) // CAST(big_l AS BIGINT)))) AS gain
           FROM tf JOIN w USING (term), s),
     f AS (SELECT item_id, r, doc_id, sum(gain) AS score FROM i JOIN g USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
       doc_id, CAST(score AS BIGINT) AS score
FROM f WHERE score > 0
QUALIFY rank <= 50
"""
