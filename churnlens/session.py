"""Session helpers: a tuned SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every churnlens job wants; the cluster's own values win where set.
_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for mapInPandas (TreeSHAP): bounded memory per batch.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def get_spark(app: str = "churnlens", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or fetch) a session with AQE, UTC and Arrow switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    On a cluster ``spark.checkpoint.dir`` names a shared (distributed) folder
    and is used as is; without it a cluster job is refused, because executors
    do not see a folder of the driver's machine.  Only a local session, as in
    tests, gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="churnlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application.

    Python tasks import the operators' numpy code by module name; executors
    need no installed package.
    """
    sc = spark.sparkContext
    if getattr(sc, "_churnlens_code", False):
        return
    root = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="churnlens-code-"), f"{root.name}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(target)
    sc._churnlens_code = True


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    For a result that several later steps read: its plan runs once, lineage is
    cut, and a lost executor costs a re-read.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
