"""What grows with the customers is joined by merge: no broadcast of it passes through the driver."""

import datetime

import pytest
from pyspark.sql import functions as F

from churnlens.operators import joins, models
from churnlens.plans import flows, queries
from churnlens.sources import steps
from churnlens.sources.fixture_view import FIXTURE_VIEW_SQL, subscriber_view


def final_plan(df):
    """Rows, and the adaptive plan as it ran."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def tables(spark, root):
    day = datetime.date(2024, 1, 1)
    orders = [(i, i % 7 or None, 100.0 * i, day + datetime.timedelta(days=9 * i), "OF"[i % 2], f"{1 + i % 3}-URGENT")
              for i in range(40)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate date, "
                                  "o_orderstatus string, o_orderpriority string").write.parquet(f"{root}/orders.parquet")
    customers = [(1, 1, -20.0, "B"), (2, 0, -10.0, "A"), (2, 1, -10.0, "A"), (3, None, 0.0, "B"), (4, 0, 10.0, "A"),
                 (5, 1, 20.0, "B"), (9, 1, 60.0, "B"), (None, 0, 1.0, "A")]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string") \
        .write.parquet(f"{root}/customer.parquet")
    spark.createDataFrame([(0, 0), (1, 0)], "n_nationkey int, n_regionkey int").write.parquet(f"{root}/nation.parquet")
    spark.createDataFrame([(0, "EAST")], "r_regionkey int, r_name string").write.parquet(f"{root}/region.parquet")


def test_the_view_joins_customers_by_merge(spark, scratch):
    import duckdb

    tables(spark, scratch)
    rows, plan = final_plan(subscriber_view(spark, scratch))
    assert "SortMergeJoin [customer_id" in plan and "BroadcastHashJoin [customer_id" not in plan
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{scratch}/{t}.parquet/*.parquet'")
    want = con.execute(FIXTURE_VIEW_SQL).fetchall()
    assert sorted(map(tuple, rows)) == sorted(want) and len(rows) == 6  # key 2 twice; 6, 9 and null have no partner


def test_merged_keeps_what_a_join_gives(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, v string")
    right = spark.createDataFrame([(2, 20), (2, 21), (3, 30), (None, 40)], "k long, s int")
    for how in ("inner", "left"):
        rows, plan = final_plan(joins.merged(left, right, "k", how))
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        key = lambda r: tuple(map(str, r))
        assert sorted(rows, key=key) == sorted(left.join(right, "k", how).collect(), key=key)


class Scores:
    """A model whose probability is the column p."""

    margin_scale = 1.0

    def score(self, df, prob="prob", prediction="prediction"):
        return df.withColumns({prob: F.col("p"), prediction: (F.col("p") > 0.5).cast("int")})


@pytest.fixture
def run(spark, monkeypatch):
    """A split table without fits: every query on it gets ``Scores``."""
    data = spark.createDataFrame([(i, i % 2, (i + 1) / 50.0, int(i < 30)) for i in range(40)],
                                 f"{queries.C.key} long, {queries.C.label} int, p double, is_test int")
    made = flows.ModelRun(None, data, data.where("is_test = 0"), data.where("is_test = 1"))
    monkeypatch.setattr(queries, "_run", lambda spark, sf_dir: made)
    monkeypatch.setattr(queries, "_gbt", lambda spark, sf_dir: Scores())
    monkeypatch.setattr(queries, "_logistic", lambda spark, sf_dir: (Scores(), Scores()))
    return made


def test_shap_check_joins_scores_by_merge(spark, monkeypatch, run):
    logit = F.log(F.col("p") / (1 - F.col("p")))
    off = F.when(F.col(queries.C.key) == 3, 0.5).otherwise(0.0)  # one row's contributions are wrong, one row has none
    parts = run.test.where(f"{queries.C.key} <> 7").select(queries.C.key, F.explode(F.array(logit * 0.25, logit * 0.75 + off)).alias("shap"))
    monkeypatch.setattr(models, "gbt_trees", lambda model, scratch_dir: [])
    monkeypatch.setattr(queries, "q_gbt_shap", lambda spark, sf_dir: parts)
    rows, plan = final_plan(queries.q_shap_check(spark, "nowhere"))
    assert [tuple(r) for r in rows] == [(30, 2, 2, 2)]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_resumed_check_joins_customers_by_merge(spark, monkeypatch, run):
    segmented = run.data.select(queries.C.key, (F.col(queries.C.key) % 3).alias("segment_id"))
    other = segmented.withColumn("segment_id", F.when(F.col(queries.C.key) == 5, 9).otherwise(F.col("segment_id")))

    class Segments:
        pass

    Segments.segmented = segmented
    monkeypatch.setattr(queries, "_segmentation", lambda spark, sf_dir: Segments)
    monkeypatch.setattr(queries, "subscriber_view", lambda spark, sf_dir: run.data)
    monkeypatch.setattr(steps, "fingerprint", lambda df: "rows")
    again = run.data.withColumn("p", F.when(F.col(queries.C.key) == 4, 0.99).otherwise(F.col("p")))
    for name, made in (("store_models", None), ("store_segmentation", None), ("resume_segmented", other),
                       ("resume_models", (again, {"gbt": Scores(), "logistic": Scores()}))):
        monkeypatch.setattr(flows, name, lambda *args, made=made, **kw: made)
    for name in ("resumed_risk", "resumed_comparison"):
        monkeypatch.setattr(flows, name, lambda spark, root, *args, **kw: None if root.endswith("-none") else segmented)
    rows, plan = final_plan(queries.q_resumed_check(spark, "nowhere"))
    assert [tuple(r) for r in rows] == [(30, 1, 40, 1, 2, 2)]
    assert plan.split("Initial Plan")[0].count("SortMergeJoin [") == 2 and "BroadcastHashJoin" not in plan
