"""Stored steps of a flow, so that a later run can start from any of them.

A step is a folder with its tables and models and, written last, a manifest:
the input's fingerprint, the artefacts and their schemas.  A step without a
manifest, as after a lost driver, does not count.  Reading a step that is
absent, or that was made from another input, warns and gives None, and the
caller skips what depends on it.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(df: DataFrame) -> str:
    """Rows and an order-free hash of all their values, in one scan."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
                                                     .cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}:{row['h']}:{','.join(sorted(df.columns))}"


@dataclass
class Step:
    """A stored step: its folder, tables and the names of its other artefacts."""

    path: str
    tables: dict[str, DataFrame]
    artefacts: list[str]


def write_step(spark: SparkSession, root: str, name: str, source: str, tables: Mapping[str, DataFrame],
               artefacts: Mapping[str, Callable[[str], None]] | None = None) -> str:
    """Write tables and artefacts (each by its writer, given a path) of a step, the manifest last; returns the folder."""
    path = f"{root.rstrip('/')}/{name}"
    # an older manifest must not vouch for tables that are being replaced
    spark.createDataFrame([("",)], "manifest string").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/tables/{table}")
    for artefact, write in (artefacts or {}).items():
        write(f"{path}/artefacts/{artefact}")
    made = {"source": source, "tables": {t: df.schema.jsonValue() for t, df in tables.items()},
            "artefacts": sorted(artefacts or {})}
    spark.createDataFrame([(json.dumps(made),)], "manifest string").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return path


def read_step(spark: SparkSession, root: str, name: str, source: str | None = None) -> Step | None:
    """The stored step, or None with a warning if it is absent, unfinished or made from another input."""
    from pyspark.errors import AnalysisException
    from pyspark.sql.types import StructType

    path = f"{root.rstrip('/')}/{name}"
    try:
        text = spark.read.schema("manifest string").json(f"{path}/manifest").first()
    except AnalysisException:
        text = None
    if text is None or not text["manifest"]:
        warnings.warn(f"step {name} is not stored in {root}: what needs it is skipped", stacklevel=2)
        return None
    made = json.loads(text["manifest"])
    if source is not None and made["source"] != source:
        warnings.warn(f"step {name} in {root} was made from another input: what needs it is skipped", stacklevel=2)
        return None
    tables = {t: spark.read.schema(StructType.fromJson(schema)).parquet(f"{path}/tables/{t}")
              for t, schema in made["tables"].items()}
    return Step(path, tables, made["artefacts"])
