"""Quality rules with adaptive thresholds (DataFrame functions only).

Every text gets its counts; rows that fail the base rules go.  Of the rest,
mergeable quantile sketches (KLL) of the ratios of a text are built per
language, source and salt, and merged to groups, to languages, to everything.
A group's fence is a quartile plus or minus ``WIDTH`` spreads, and the spread
is the narrowest quantile range of the group that is not empty, in units of an
interquartile range: a ratio that hardly ever differs from one value is judged
by the quantiles further out.  A fence is shrunk towards that of the language,
and this towards that of all rows, by the number of rows it rests on.  The
documents are joined with the fences of their group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.common import SPACE, read_table, stored, word_array

WINDOW = 5


@dataclass(frozen=True)
class Ratio:
    """A statistic of a text and its fenced sides."""

    expression: str
    low: bool = False
    high: bool = True


# The order fixes the positions in the arrays of statistics and fences.
RATIOS = {
    "word_length": Ratio("word_chars / n_words", low=True),
    "symbols_per_word": Ratio("n_symbols / n_words"),
    "upper_per_char": Ratio("n_upper / greatest(word_chars, 1)"),
    "dup_line_share": Ratio("n_dup_lines / greatest(n_lines, 1)"),
    "repeat_word_share": Ratio("n_repeat_words / n_words"),
}
WIDTH = 10.0  # spreads beyond the quartile
PRIOR_ROWS = 20  # rows that the parent's fence counts for
SKETCH_K = 4_096  # sketches of at most so many rows are exact
SALTS = 16
# Lower and upper quantile of each range, and its width in interquartile ranges of a normal distribution.
RANGES = ((0.25, 0.75, 1.0), (0.05, 0.95, 2.4387), (0.02, 0.98, 3.0449))
QUANTILES = [q for a, b, _ in RANGES for q in (a, b)]


def counts(docs: DataFrame, *keep: str) -> DataFrame:
    """The base counts of every row; ``keep`` columns of ``docs`` come first.

    A null text counts as empty.  A repeated window is found by its hash
    (64 bit over five word hashes); only texts in which a window repeats sort
    their windows to mark the words covered.
    """
    text = F.coalesce("text", F.lit(""))
    df = docs.select(*keep, text.alias("t"), word_array(F.col("text")).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        *keep, F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", SPACE + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        lines.alias("l"), F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    window = F.transform(F.sequence(F.lit(0), F.size("w") - WINDOW),
                         lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]))
    df = df.select(*[c for c in df.columns if c not in ("l", "w")],
                   F.size("l").cast("long").alias("n_lines"),
                   (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
                   F.when(F.size("w") > WINDOW, window).alias("g"))
    repeats = F.size(F.array_distinct("g")) < F.size("g")
    df = df.withColumn("z", F.when(repeats, F.array_sort(F.transform(
        "g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("g")

    def same(k: Column, step: int) -> Column:
        return F.coalesce(F.get("z", k + step)["h"] == F.get("z", k)["h"], F.lit(False))

    found = F.transform(F.sequence(F.lit(0), F.size("z") - 1),
                        lambda k: F.when(same(k, -1) | same(k, 1), F.get("z", k)["i"]))
    df = df.withColumn("p", F.when(F.col("z").isNotNull(), F.array_sort(F.filter(found, lambda i: i.isNotNull()))))
    covered = F.aggregate(F.transform("p", lambda i, k: F.least(F.coalesce(F.get("p", k + 1) - i, F.lit(WINDOW)),
                                                               F.lit(WINDOW)).cast("long")),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("z", "p")


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, n, s0, s1, ...: a stored sketch of every ratio per group.

    A group is sketched in ``SALTS`` parts that are merged, so none meets
    whole in one task; later rows can be merged in the same way.
    """
    made = [F.kll_sketch_agg_double(F.get("ratios", F.lit(i)), SKETCH_K).alias(f"s{i}") for i in range(len(RATIOS))]
    merged = [F.kll_merge_agg_double(f"s{i}").alias(f"s{i}") for i in range(len(RATIOS))]
    salt = F.pmod(F.xxhash64("ratios"), F.lit(SALTS)).alias("salt")
    parts = rows.where("ratios is not null").groupBy("lang", "source", salt).agg(F.count("*").alias("n"), *made)
    return stored(parts.groupBy("lang", "source").agg(F.sum("n").alias("n"), *merged), "rules-sketches")


def own_fences(groups: DataFrame, width: float) -> DataFrame:
    """The groups with lo0, hi0, lo1, ...: fences from their sketches alone; null where every range is empty."""
    ranks = F.array(*[F.lit(q) for q in QUANTILES])
    df = groups.select("*", *[F.kll_sketch_get_quantile_double(f"s{i}", ranks).alias(f"q{i}") for i in range(len(RATIOS))])
    out = []
    for i, r in enumerate(RATIOS.values()):
        at = lambda q, i=i: F.get(f"q{i}", F.lit(QUANTILES.index(q)))
        spread = F.coalesce(*[F.nullif((at(b) - at(a)) / unit, F.lit(0.0)) for a, b, unit in RANGES])
        out += [((at(0.25) - width * spread) if r.low else F.lit(None).cast("double")).alias(f"lo{i}"),
                ((at(0.75) + width * spread) if r.high else F.lit(None).cast("double")).alias(f"hi{i}")]
    keep = [c for c in groups.columns if c not in [f"s{i}" for i in range(len(RATIOS))]]
    return df.select(*keep, *out)


FENCES = [f"{side}{i}" for i in range(len(RATIOS)) for side in ("lo", "hi")]


def shrunk(own: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    """``own`` fences drawn towards the parent's, which count for ``PRIOR_ROWS`` rows; either alone if one is null."""
    match = F.lit(True)
    for c in on:
        match = match & F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`"))
    both = [((F.col("a.n") * F.col(f"a.{c}") + PRIOR_ROWS * F.col(f"b.{c}")) / (F.col("a.n") + PRIOR_ROWS)) for c in FENCES]
    joined = own.alias("a").join(parent.alias("b"), match)
    keep = [F.col(f"a.`{c}`") for c in own.columns if c not in FENCES]
    return joined.select(*keep, *[F.coalesce(x, F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for x, c in zip(both, FENCES)])


def fences(rows: DataFrame, width: float = WIDTH) -> DataFrame:
    """lang, source and the fences of every group, stored."""
    groups = sketches(rows)
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(f"s{i}").alias(f"s{i}") for i in range(len(RATIOS))]]
    by_lang = groups.groupBy("lang").agg(*merged)
    of_all = own_fences(by_lang.agg(*merged).where("n > 0"), width)
    by_lang = shrunk(own_fences(by_lang, width), of_all, [])
    return stored(shrunk(own_fences(groups, width), by_lang, ["lang"]).drop("n"), "rules-fences")


def judged(docs: DataFrame, *keep: str, width: float = WIDTH) -> DataFrame:
    """``keep`` columns, the counts, base_failed and kept of every row.

    ``docs`` has text, lang and source; null languages and sources are groups
    of their own.  Thresholds come from all rows that pass the base rules; if
    none does, no row is kept.  A ratio that is the same in (nearly) all rows
    of everything has no fence.  Repeated rows are judged alike; an empty
    table gives an empty result.
    """
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = counts(docs.select(*dict.fromkeys((*keep, "lang", "source", "text"))), *dict.fromkeys((*keep, "lang", "source")))
    rows = stored(rows.withColumn("base_failed", base), "rules-counts")
    ratios = F.when(~F.col("base_failed"), F.array(*[F.expr(r.expression) for r in RATIOS.values()]))
    rows = rows.withColumn("ratios", ratios)
    limits = fences(rows, width).select(F.col("lang").alias("_l"), F.col("source").alias("_s"), *FENCES)
    out = rows.join(limits, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    inside = F.lit(True)
    for i in range(len(RATIOS)):
        x = F.get("ratios", F.lit(i))
        inside = inside & F.coalesce(x >= F.col(f"lo{i}"), F.lit(True)) & F.coalesce(x <= F.col(f"hi{i}"), F.lit(True))
    return out.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & inside).alias("kept"))


def keep_passing(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they came."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "lang", "source", "text")
    kept = judged(whole, "_doc", **how).where("kept")
    return kept.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])


def op10_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the adaptive verdict of every whole text of ``documents``."""
    return judged(read_table(spark, sf_dir, "documents"), "doc_id")


def _sql() -> str:
    """The DuckDB twin: the same fences from exact order statistics."""
    ratios = [r.expression for r in RATIOS.values()]
    listed = ", ".join(f"{e} AS x{i}" for i, e in enumerate(ratios))
    picks = ", ".join(f"list_sort(list(x{i})) AS s{i}" for i in range(len(ratios)))
    at = lambda i, q: f"s{i}[CAST(greatest(ceil({q} * n), 1) AS BIGINT)]"
    own, inside = [], []
    for i, r in enumerate(RATIOS.values()):
        spread = "coalesce(" + ", ".join(f"nullif(({at(i, b)} - {at(i, a)}) / {unit}, 0.0)" for a, b, unit in RANGES) + ")"
        own.append((f"{at(i, 0.25)} - {WIDTH} * {spread}" if r.low else "CAST(NULL AS DOUBLE)") + f" AS lo{i}")
        own.append((f"{at(i, 0.75)} + {WIDTH} * {spread}" if r.high else "CAST(NULL AS DOUBLE)") + f" AS hi{i}")
        inside.append(f"coalesce(x{i} >= lo{i}, TRUE) AND coalesce(x{i} <= hi{i}, TRUE)")
    drawn = ", ".join(f"coalesce((a.n * a.{c} + {PRIOR_ROWS} * b.{c}) / (a.n + {PRIOR_ROWS}), a.{c}, b.{c}) AS {c}" for c in FENCES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
     w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
     g AS (SELECT r, i, list_slice(w, i, i + 4) AS g
           FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
     twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
     rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 5) AS k(k) GROUP BY r),
     c AS (SELECT w.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
                  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                  CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                  CAST(length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS BIGINT) AS n_upper,
                  CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
           FROM w LEFT JOIN rep ON rep.r = w.r),
     b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
     x AS (SELECT *, {listed} FROM b),
     q AS (SELECT lang, source, grouping(lang, source) AS level, count(*) AS n, {picks}
           FROM x WHERE NOT base_failed GROUP BY ROLLUP (lang, source)),
     o AS (SELECT lang, source, level, n, {", ".join(own)} FROM q),
     l AS (SELECT a.lang, a.n, {drawn} FROM o a, o b WHERE a.level = 1 AND b.level = 3),
     f AS (SELECT a.lang, a.source, {drawn} FROM o a JOIN l b ON a.lang IS NOT DISTINCT FROM b.lang WHERE a.level = 0),
     j AS (SELECT x.*, {", ".join(f"f.{c}" for c in FENCES)}
           FROM x LEFT JOIN f ON f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(inside)} AS kept
FROM j
"""


OP10_SQL = _sql()
