"""Retention-initiative impact estimate.

Three initiatives on one customer table:

1. onboarding: customers with tenure <= 12; saved = int(n*now) - int(n*target);
2. contract conversion: a share of month-to-month customers converts;
   saved = int(int(n*share) * (rate_now - rate_after));
3. add-ons in the riskiest segment; saved = int(int(n*uptake) * (now - after)).

Revenue = saved x monthly charge x 12.  The first two use the overall mean
monthly charge; the third the riskiest segment's size and mean charge
(computed, where the reference typed both in).  Totals are plain sums; a
customer may count in several initiatives, so the total overstates.

Everything is one aggregation over the table plus one over the segment
profile, then a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions import trunc_int
from churnlens.schema import ImpactConfig, SubscriberColumns


def estimate_impact(df: DataFrame, cols: SubscriberColumns, segment: str,
                    cfg: ImpactConfig = ImpactConfig()) -> DataFrame:
    base = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum(cols.label).cast("long").alias("n_churners"),
        F.avg(cols.monthly).alias("avg_monthly"),
        F.count_if(F.col(cols.tenure) <= cfg.new_tenure_max).alias("n_new"),
        F.count_if(F.col(cols.contract) == cols.month_to_month).alias("n_monthly"))
    seg = (df.groupBy(segment)
           .agg(F.avg(cols.label).alias("r"), F.count(F.lit(1)).alias("n"),
                F.avg(cols.monthly).alias("charge"))
           .agg(F.max_by(F.struct("n", "charge"), F.struct(F.col("r"), F.col("n"), F.col(segment))).alias("top")))
    top = seg.select("top").scalar()
    n_risk, charge_risk = top.getField("n"), top.getField("charge")

    def lit(x):
        return F.lit(float(x))

    saved1 = (trunc_int(F.col("n_new") * lit(cfg.onboarding_rate_now))
              - trunc_int(F.col("n_new") * lit(cfg.onboarding_rate_target)))
    n_convert = trunc_int(F.col("n_monthly") * lit(cfg.conversion_share))
    saved2 = trunc_int(n_convert * (lit(cfg.conversion_rate_now) - lit(cfg.conversion_rate_after)))
    n_addons = trunc_int(n_risk * lit(cfg.addon_uptake))
    saved3 = trunc_int(n_addons * (lit(cfg.addon_rate_now) - lit(cfg.addon_rate_after)))
    months = lit(cfg.months)
    rev = F.col("avg_monthly") * months
    wide = base.select(
        "n_total", "n_churners", "avg_monthly",
        F.col("n_new").alias("target_1"), saved1.alias("saved_1"), (saved1 * rev).alias("revenue_1"),
        F.col("n_monthly").alias("target_2"), saved2.alias("saved_2"), (saved2 * rev).alias("revenue_2"),
        n_risk.cast("long").alias("target_3"), saved3.alias("saved_3"),
        (saved3 * charge_risk * months).alias("revenue_3"))
    rows = [F.struct(F.lit(name).alias("initiative"), F.col(f"target_{i}").cast("long").alias("target"),
                     F.col(f"saved_{i}").cast("long").alias("saved"),
                     F.col(f"revenue_{i}").alias("revenue"))
            for i, name in [(1, "onboarding"), (2, "contract_conversion"), (3, "addon_trial")]]
    total = F.struct(F.lit("total").alias("initiative"), F.lit(None).cast("long").alias("target"),
                     (F.col("saved_1") + F.col("saved_2") + F.col("saved_3")).cast("long").alias("saved"),
                     (F.col("revenue_1") + F.col("revenue_2") + F.col("revenue_3")).alias("revenue"))
    return wide.select(F.explode(F.array(*rows, total)).alias("e")).select("e.*")
