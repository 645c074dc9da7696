"""Subscriber view derived from the driver's order tables.

One row per customer with at least one order:

=================  ==========================================================
customer_id        ``c_custkey``
contract           ``c_mktsegment``
region             region name of the customer's nation
priority           priority of the customer's first order (smallest key)
senior             1 if the account balance is negative
paperless          'Yes' if any order is open (status 'O'), else 'No'
urgent             'Yes' if any order is '1-URGENT', else 'No'
high_value         'No credit' for a negative balance, else 'Yes' if an order
                   exceeds 300,000, else 'No'
n_orders           number of orders
total_charges      sum of ``o_totalprice`` as DECIMAL(18,2), as double
monthly_charges    total_charges / n_orders
tenure             ceil(days between first and last order / 30.0)
churn              'Yes' if the last order is more than 180 days before the
                   newest order of all customers
churn_binary       churn as 0/1
=================  ==========================================================

Plan: the orders aggregate is one hash aggregation keyed by customer (partial
aggregation map-side, so a customer holding a third of all orders costs one
row per map task); the customer join reuses that key and merges, as neither
side is bounded and a broadcast would pass through the driver; nation and region
(fixed dimension tables) are broadcast by hint; the newest order date is a scalar
subquery.  Building the view runs no job, and ``orders`` is read twice: for the
facts and for the newest date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.joins import merged

# Fixed values of the view definition.
CHURN_GAP_DAYS = 180
TENURE_DAY_UNIT = 30.0
HIGH_VALUE_PRICE = 300000.0


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subscriber_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    odate = F.to_date("o_orderdate")
    # The first order's priority rides along as a struct minimum.  Its string
    # makes the aggregation sort-based, but only for queries that read the
    # priority: for all others the planner prunes it and hashes.
    per_customer = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_charges"),
        F.min(odate).alias("first_date"),
        F.max(odate).alias("last_date"),
        F.min(F.struct("o_orderkey", "o_orderpriority")).alias("first_order"),
        F.bool_or(F.col("o_orderstatus") == "O").alias("any_open"),
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("any_urgent"),
        F.max("o_totalprice").alias("max_price"),
    )
    newest = orders.select(F.max(odate)).scalar()

    geo = (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
           .select("n_nationkey", F.col("r_name").alias("region")))
    cust = (customer.select(F.col("c_custkey").alias("customer_id"), "c_nationkey",
                            "c_acctbal", F.col("c_mktsegment").alias("contract"))
            .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"), "left"))

    churned = F.datediff(newest, F.col("last_date")) > F.lit(CHURN_GAP_DAYS)
    return (merged(per_customer, cust, "customer_id")
            .select(
                "customer_id", "contract", "region",
                F.col("first_order.o_orderpriority").alias("priority"),
                (F.col("c_acctbal") < 0).cast("int").alias("senior"),
                F.when(F.col("any_open"), "Yes").otherwise("No").alias("paperless"),
                F.when(F.col("any_urgent"), "Yes").otherwise("No").alias("urgent"),
                F.when(F.col("c_acctbal") < 0, "No credit")
                 .when(F.col("max_price") > F.lit(HIGH_VALUE_PRICE), "Yes")
                 .otherwise("No").alias("high_value"),
                "n_orders",
                "total_charges",
                (F.col("total_charges") / F.col("n_orders")).alias("monthly_charges"),
                F.ceil(F.datediff("last_date", "first_date") / F.lit(TENURE_DAY_UNIT))
                 .cast("int").alias("tenure"),
                F.when(churned, "Yes").otherwise("No").alias("churn"),
                churned.cast("int").alias("churn_binary"),
            ))


FIXTURE_VIEW_SQL = f"""
WITH per_customer AS (
  SELECT o_custkey AS customer_id,
         count(*) AS n_orders,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_charges,
         min(CAST(o_orderdate AS DATE)) AS first_date,
         max(CAST(o_orderdate AS DATE)) AS last_date,
         arg_min(o_orderpriority, o_orderkey) AS priority,
         bool_or(o_orderstatus = 'O') AS any_open,
         bool_or(o_orderpriority = '1-URGENT') AS any_urgent,
         max(o_totalprice) AS max_price
  FROM orders GROUP BY o_custkey
), newest AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders)
SELECT p.customer_id,
       c.c_mktsegment AS contract,
       r.r_name AS region,
       p.priority,
       CAST(c.c_acctbal < 0 AS INTEGER) AS senior,
       CASE WHEN p.any_open THEN 'Yes' ELSE 'No' END AS paperless,
       CASE WHEN p.any_urgent THEN 'Yes' ELSE 'No' END AS urgent,
       CASE WHEN c.c_acctbal < 0 THEN 'No credit'
            WHEN p.max_price > {HIGH_VALUE_PRICE} THEN 'Yes' ELSE 'No' END AS high_value,
       p.n_orders,
       p.total_charges,
       p.total_charges / p.n_orders AS monthly_charges,
       CAST(ceil(date_diff('day', p.first_date, p.last_date) / {TENURE_DAY_UNIT}) AS INTEGER) AS tenure,
       CASE WHEN date_diff('day', p.last_date, (SELECT d FROM newest)) > {CHURN_GAP_DAYS}
            THEN 'Yes' ELSE 'No' END AS churn,
       CAST(date_diff('day', p.last_date, (SELECT d FROM newest)) > {CHURN_GAP_DAYS} AS INTEGER)
            AS churn_binary
FROM per_customer p
JOIN customer c ON c.c_custkey = p.customer_id
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
"""
