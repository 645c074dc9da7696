"""Model persistence (S4): Spark's own ``PipelineModel`` writer and reader; boosted trees as a table beside it.

The feature names travel in a small JSON sidecar so a reloaded model can be
explained and its coefficients labelled.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from churnlens.operators.boosting import BoostedModel
from churnlens.operators.models import ChurnModel, load_model


def save_model(model: ChurnModel | BoostedModel, path: str) -> None:
    model.save(f"{path}/pipeline")
    spark = SparkSession.getActiveSession()
    meta = json.dumps({"kind": model.kind, "names": list(model.names), "label": model.label})
    spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(
        f"{path}/meta")


def read_model(path: str) -> ChurnModel | BoostedModel:
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    if meta["kind"] == "boosted":
        return BoostedModel.load(f"{path}/pipeline", meta["names"], meta["label"])
    return load_model(f"{path}/pipeline", meta["kind"], meta["names"], meta["label"])
