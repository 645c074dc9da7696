"""Scoring a stream of customer records with a fitted churn model.

The reference names real-time scoring only as future work; this is the
Spark-native form of it and nothing more: a fitted ``PipelineModel`` is a
row-wise projection (SQL encoding, vector assembly, model), so it applies to
a streaming DataFrame unchanged.  No state, no watermark needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from churnlens.operators.models import ChurnModel


def score_stream(model: ChurnModel, stream: DataFrame, key: str) -> DataFrame:
    """``(key, prob, prediction)`` for every arriving record."""
    return model.score(stream).select(key, "prob", "prediction")


def start_scoring(model: ChurnModel, stream: DataFrame, key: str, sink_path: str,
                  checkpoint: str, trigger_seconds: int | None = None) -> StreamingQuery:
    """Append scores to a parquet sink with a checkpoint (exactly-once file sink)."""
    w = (score_stream(model, stream, key).writeStream.format("parquet")
         .option("path", sink_path).option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    else:
        w = w.trigger(availableNow=True)
    return w.start()
