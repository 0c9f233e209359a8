"""Churn labels and leakage-free behaviour features.

T0 = max(order_date) - churn period. Features only use orders strictly
before T0; the label looks at the whole period. All scalars are one-row
frames broadcast back; the per-user work is a single grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.operators.stats import money_sum, with_scalars
from cartlens.schema import CHURN_PERIOD_DAYS, RECENT_WINDOW_DAYS


def _days(n: int):
    return F.make_interval(days=F.lit(int(n)))


def cutoff(order_kpi: DataFrame, churn_period_days: int = CHURN_PERIOD_DAYS) -> DataFrame:
    """H1: one row with ``snapshot_date`` and ``cutoff_date``."""
    return (order_kpi.agg(F.max("order_date").alias("snapshot_date"))
            .withColumn("cutoff_date", F.col("snapshot_date") - _days(churn_period_days)))


def orders_before_cutoff(order_kpi: DataFrame, cut: DataFrame) -> DataFrame:
    """H2: orders with order_date < T0."""
    return (with_scalars(order_kpi, cut.select("cutoff_date"))
            .where(F.col("order_date") < F.col("cutoff_date")).drop("cutoff_date"))


def orders_after_cutoff(order_kpi: DataFrame, cut: DataFrame) -> DataFrame:
    """H3: orders with T0 <= order_date <= snapshot."""
    return (with_scalars(order_kpi, cut)
            .where((F.col("order_date") >= F.col("cutoff_date"))
                   & (F.col("order_date") <= F.col("snapshot_date")))
            .drop("cutoff_date", "snapshot_date"))


def churn_labels(order_kpi: DataFrame, cut: DataFrame) -> DataFrame:
    """H4-H5: last order per user over the whole period; churned = last < T0.

    An order exactly at T0 counts as active; a null last date gives 0.
    """
    last = (order_kpi.where(F.col("user_uid").isNotNull()).groupBy("user_uid")
            .agg(F.max("order_date").alias("last_order_date")))
    return (with_scalars(last, cut.select("cutoff_date"))
            .withColumn("churned", F.coalesce(F.col("last_order_date") < F.col("cutoff_date"),
                                              F.lit(False)).cast("int"))
            .drop("cutoff_date"))


def churn_distribution(labels: DataFrame) -> DataFrame:
    """H6: users per label, with the display name."""
    return (labels.groupBy("churned").agg(F.count(F.lit(1)).alias("num_users"))
            .withColumn("status", F.when(F.col("churned") == 1, F.lit("Churned"))
                        .otherwise(F.lit("Active"))))


def behavior_features(order_kpi: DataFrame, cut: DataFrame,
                      recent_days: int = RECENT_WINDOW_DAYS) -> DataFrame:
    """Pre-T0 per-user aggregates in one pass.

    ``orders_last_30d`` counts orders in [T0 - 30d, T0) inside the same
    aggregate, instead of a second grouped count and a join.
    """
    before = orders_before_cutoff(order_kpi, cut).where(F.col("user_uid").isNotNull())
    t0 = cut.select("cutoff_date", (F.col("cutoff_date") - _days(recent_days)).alias("_recent_start"))
    agg = (with_scalars(before, t0)
           .groupBy("user_uid")
           .agg(F.min("order_date").alias("first_order_date"),
                F.max("order_date").alias("last_order_before_T0"),
                F.count("order_uid").alias("freq_total"),
                money_sum("order_revenue").alias("monetary_total"),
                F.count_if(F.col("order_date") >= F.col("_recent_start")).alias("orders_last_30d")))
    return (with_scalars(agg, cut.select("cutoff_date"))
            .withColumn("tenure_days", F.timestamp_diff("DAY", F.col("first_order_date"), F.col("cutoff_date")))
            .withColumn("avg_order_value", F.col("monetary_total") / F.col("freq_total"))
            .drop("cutoff_date")
            .select("user_uid", "first_order_date", "last_order_before_T0", "freq_total",
                    "monetary_total", "tenure_days", "avg_order_value", "orders_last_30d"))
