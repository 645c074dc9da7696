"""Subscriber scans and sinks (S1-S3, S5) and the load-and-clean chain.

Scans declare their schema (no inference pass over the data); the raw total
charge stays text so rejects are counted, then ``to_number`` coerces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.clean import add_label, coerce_numeric, drop_missing
from churnlens.schema import SUBSCRIBER, SUBSCRIBER_SCHEMA, SubscriberColumns
from churnlens.session import materialize

CORRUPT = "_corrupt"


def read_subscribers(spark: SparkSession, path: str, fmt: str = "csv",
                     schema=SUBSCRIBER_SCHEMA) -> DataFrame:
    """Raw subscriber table (S1): CSV with header, UTF-8, or parquet.

    Unlike pandas, Spark keeps tokens such as ``NA`` as text; only empty
    fields are null.  Text columns are coerced explicitly downstream.
    """
    if fmt == "csv":
        return (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
                .option("mode", "PERMISSIVE").csv(path))
    return spark.read.format(fmt).load(path)


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType = SUBSCRIBER_SCHEMA,
                      header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A CSV as ``(good rows, rejects)``; no row is lost on the way.

    Every field is read as text, so a value that does not fit its type is seen
    and not silently null.  A row is rejected if its number of fields differs
    from the schema's or a non-blank field is not of its column's type.
    ``rejects`` has one row per fault: ``row`` (the line as read), ``column``
    (null for a wrong number of fields), ``value``, ``reason``.  Blank fields
    are null, not faults.  The text is parsed once and stored; both results
    read it.
    """
    text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema), T.StructField(CORRUPT, T.StringType())])
    raw = materialize(spark.read.schema(text).option("header", header).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
                      .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", True).csv(path), "csv-rows")
    typed = [f for f in schema if not isinstance(f.dataType, T.StringType)]

    def cast(f: T.StructField):
        return F.trim(F.col(f"`{f.name}`")).try_cast(f.dataType)

    def fault(column, value, reason):
        return F.struct(column.cast("string").alias("column"), value.alias("value"), F.lit(reason).alias("reason"))

    whole = F.col(CORRUPT).isNull()
    faults = [F.when(~whole, fault(F.lit(None), F.col(CORRUPT), "number of fields"))]
    for f in typed:
        x = F.col(f"`{f.name}`")
        bad = whole & (F.trim(x) != "") & cast(f).isNull()
        faults.append(F.when(bad, fault(F.lit(f.name), x, f"not {f.dataType.simpleString()}")))
    marked = raw.withColumn("_faults", F.filter(F.array(*faults), lambda x: x.isNotNull()))
    good = marked.where(F.size("_faults") == 0).select(
        *[(cast(f) if f in typed else F.col(f"`{f.name}`")).alias(f.name) for f in schema])
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in schema])))
    rejects = marked.where(F.size("_faults") > 0).select(line.alias("row"), F.explode("_faults").alias("f")).select("row", "f.*")
    return good, rejects


def load_subscribers(spark: SparkSession, path: str, fmt: str = "csv",
                     cols: SubscriberColumns = SUBSCRIBER) -> tuple[DataFrame, Observation]:
    """S1 -> P1 (coerce total) -> P2 (drop rows without it) -> P3 (label).

    Returns the clean table and an ``Observation`` with ``rows_in`` and
    ``rows_dropped`` (filled by the first action on the table).
    """
    raw = read_subscribers(spark, path, fmt)
    coerced = coerce_numeric(raw, cols.total)
    kept, obs = drop_missing(coerced, [cols.total], name="load_subscribers")
    return add_label(kept, cols.label_text, "Yes", cols.label), obs


def read_segmented(spark: SparkSession, path: str,
                   cols: SubscriberColumns = SUBSCRIBER) -> tuple[DataFrame, Observation]:
    """Re-read a segmented table (S2) and apply the same coercion and drop."""
    raw = spark.read.parquet(path)
    coerced = coerce_numeric(raw, cols.total)
    return drop_missing(coerced, [cols.total], name="read_segmented")


def write_segmented(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Raw columns + label + segment id, overwrite (S3)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_report(df: DataFrame, root: str, name: str) -> str:
    """Persist the table behind a report figure."""
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path
