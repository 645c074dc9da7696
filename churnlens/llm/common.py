"""Helpers shared by the operators of this subpackage.

Intermediate tables go to the shared folder that the cluster names in
``spark.checkpoint.dir`` (see :func:`churnlens.session.ensure_checkpoint_dir`);
they cut lineage, so a lost executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.session import ensure_checkpoint_dir

# The word separators of all operators (space, tab, newline,
# vertical tab, form feed, carriage return), as a regex class.
SPACE = r"[\x20\x09-\x0D]"

TEXTS_PER_BATCH = 2_000

_SHIPPED = "_churnlens_shipped"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as a lazy scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors once per SparkContext, and bound Arrow batches.

    Python workers import the operators' kernels by module name, so their
    caches live as long as a worker and not as long as a task.
    """
    sc = spark.sparkContext
    # texts are large: fewer of them in an Arrow batch keep a worker's memory low
    batch = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < batch <= TEXTS_PER_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    if getattr(sc, _SHIPPED, False):
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="churnlens-code-"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(target)
    setattr(sc, _SHIPPED, True)


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_array(text: Column) -> Column:
    """Words of a text (runs without separators) as an array; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, tag: str) -> DataFrame:
    """``df`` with the row's 0-based position in its group, in ``order``.

    No group meets in one task: rows are range-partitioned by group and order,
    the partitions are written with their number, counted by (group,
    partition), and a running sum over these counts gives each part its
    offset.  The order should be total; ties are numbered arbitrarily.
    """
    part = f"_{name}_part"
    rows = stored(df.repartitionByRange(*group, *order).withColumn(part, F.spark_partition_id()), tag)
    by = ", ".join(f"`{c}`" for c in group)
    sizes = rows.groupBy(*group, part).agg(F.count("*").alias("_n"))
    sizes = sizes.withColumn("_base", F.expr(f"sum(_n) over (partition by {by} order by `{part}` "
                                             "rows between unbounded preceding and current row) - _n"))
    match = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")) for c in (*group, part)]
    local = F.expr(f"row_number() over (partition by {by}, `{part}` order by "
                   + ", ".join(f"`{c}`" for c in order) + ") - 1")
    joined = rows.withColumn("_local", local).alias("a").join(sizes.alias("b"), reduce(lambda x, y: x & y, match))
    return joined.select("a.*", (F.col("b._base") + F.col("a._local")).alias(name)).drop(part, "_local")


def connected_components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, root) for every node of an undirected graph (u, v) of longs.

    Alternating large-star / small-star contraction: each round is a few
    hash aggregations and joins on edges, never a collected component; the
    number of rounds grows with the logarithm of the longest chain.  Each
    round is checkpointed, and the loop ends when a round changes nothing.
    Roots are the smallest node of a component; roots are not listed as nodes.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = (edges.where("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = e.checkpoint()
    seen = None
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        e = (linked.select("u", F.col("m").alias("v"))
             .union(linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
             .distinct().checkpoint())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
