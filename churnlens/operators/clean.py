"""Cleaning: coercion, null-row drop with counts, label, projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions import binarize, to_number


def coerce_numeric(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Replace text columns by lenient doubles (P1); numeric columns pass through."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    kinds = dict(df.dtypes)
    return df.withColumns({c: (to_number(c) if kinds[c] == "string" else F.col(c).cast("double"))
                           for c in columns})


def drop_missing(df: DataFrame, subset: Sequence[str] | str,
                 name: str = "drop_missing") -> tuple[DataFrame, Observation]:
    """Drop rows with a null (or NaN) in ``subset``.

    Returns the cleaned frame and an ``Observation`` that, once any action on
    the frame has run, holds ``rows_in`` and ``rows_dropped``: the counts ride
    along with the first scan instead of needing a second one.
    """
    subset = [subset] if isinstance(subset, str) else list(subset)
    kinds = dict(df.dtypes)

    def missing(c):
        m = F.col(c).isNull()
        return m | F.isnan(c) if kinds[c] in ("double", "float") else m

    any_missing = missing(subset[0])
    for c in subset[1:]:
        any_missing = any_missing | missing(c)
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_in"),
                          F.count_if(any_missing).alias("rows_dropped"))
    return observed.where(~any_missing), obs


def add_label(df: DataFrame, source: str, positive: str = "Yes",
              name: str | None = None) -> DataFrame:
    """0/1 label from a text column (P3); null counts as 0."""
    return df.withColumn(name or f"{source}_binary", binarize(source, positive))


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the named columns in the given order."""
    return df.select(*columns)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Friendly names (P5)."""
    return df.withColumnsRenamed(mapping)


def census(df: DataFrame) -> DataFrame:
    """Counts of rows, columns, numeric and string columns.

    The column counts come from the schema; only the row count is a job.
    """
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in df.schema.fields)
    strings = sum(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(numeric).alias("n_numeric"),
        F.lit(strings).alias("n_string"))
