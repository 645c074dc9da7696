"""Reject channel of the CSV scan; stored steps with manifests."""

import warnings

import pytest
from pyspark.sql import functions as F

from churnlens.schema import SUBSCRIBER_SCHEMA
from churnlens.sources import steps
from churnlens.sources.subscribers import read_with_rejects

HEADER = ",".join(f.name for f in SUBSCRIBER_SCHEMA)
GOOD = ("A-1,Male,0,Yes,No,1,No,No phone service,DSL,No,Yes,No,No,No,No,Month-to-month,Yes,"
        "Electronic check,29.85,29.85,No")


def test_rejects_name_row_column_and_reason(spark, scratch):
    lines = [HEADER, GOOD, GOOD.replace("A-1", "B-2").replace(",29.85,29.85,", ",cheap, ,"),
             GOOD.replace("A-1", "C-3") + ",extra", "D-4,Male,0", GOOD.replace("A-1,Male,0", "E-5,Male,none").replace(",1,No", ",x,No"),
             GOOD.replace("A-1,Male,0,Yes,No,1", "F-6,Male,,Yes,No,"), '"G,7"' + GOOD[3:].replace("29.85,29.85", "1e2, ")]
    with open(f"{scratch}/subscribers.csv", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    good, rejects = read_with_rejects(spark, f"{scratch}/subscribers.csv")
    rows = {r["customerID"]: r for r in good.collect()}
    assert set(rows) == {"A-1", "F-6", "G,7"} and good.schema == SUBSCRIBER_SCHEMA
    assert rows["F-6"]["SeniorCitizen"] is None and rows["F-6"]["tenure"] is None and rows["G,7"]["MonthlyCharges"] == 100.0
    found = {(r["row"].split(",")[0], r["column"], r["reason"], r["value"]) for r in rejects.collect()}
    assert found == {("B-2", "MonthlyCharges", "not double", "cheap"), ("C-3", None, "number of fields", lines[3]),
                     ("D-4", None, "number of fields", "D-4,Male,0"), ("E-5", "SeniorCitizen", "not int", "none"),
                     ("E-5", "tenure", "not int", "x")}


def test_steps_count_only_when_finished(spark, scratch):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    source = steps.fingerprint(df)
    assert source == steps.fingerprint(df.repartition(3)) != steps.fingerprint(df.where("id < 4"))

    def fails(path):
        raise RuntimeError("lost")

    with pytest.warns(UserWarning, match="not stored"):
        assert steps.read_step(spark, scratch, "one") is None
    with pytest.raises(RuntimeError):
        steps.write_step(spark, scratch, "one", source, {"t": df}, {"model": fails})
    with pytest.warns(UserWarning, match="not stored"):
        assert steps.read_step(spark, scratch, "one") is None  # tables are there, the manifest is not
    steps.write_step(spark, scratch, "one", source, {"t": df}, {"model": lambda path: df.write.parquet(path)})
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        step = steps.read_step(spark, scratch, "one", source)
    assert step.artefacts == ["model"] and step.tables["t"].dtypes == df.dtypes
    assert sorted(map(tuple, step.tables["t"].collect())) == sorted(map(tuple, df.collect()))
    with pytest.warns(UserWarning, match="another input"):
        assert steps.read_step(spark, scratch, "one", "other") is None
    with pytest.raises(RuntimeError):  # a failed rewrite leaves no finished step behind
        steps.write_step(spark, scratch, "one", source, {"t": df}, {"model": fails})
    with pytest.warns(UserWarning):
        assert steps.read_step(spark, scratch, "one") is None
