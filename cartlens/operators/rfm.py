"""RFM segmentation.

Plan: order_kpi -> per-user aggregate (one shuffle by user) -> one global
aggregate for snapshot and quintile breaks (one row, broadcast back) ->
scores and segments as column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.operators.stats import money_sum, one_row, quantiles, with_scalars
from cartlens.schema import RFM_OTHER, RFM_QUINTILES, RFM_SEGMENTS
from cartlens.session import cut_lineage


def rfm_base(order_kpi: DataFrame, snapshot_offset_days: int = 1) -> DataFrame:
    """Per user last order, order count, revenue, recency in whole days.
    The orders are read once; the per-user table is materialised here (a job runs).

    snapshot = max(order_date) over all orders + ``snapshot_offset_days``.
    """
    per_user = cut_lineage(order_kpi.groupBy("user_uid")
                           .agg(F.max("order_date").alias("last_order_date"),
                                F.count("order_uid").alias("frequency"),
                                money_sum("order_revenue").alias("monetary")))
    # The row of the orders without a user only counts for the snapshot.
    snap = per_user.agg(
        (F.max("last_order_date") + F.make_interval(days=F.lit(snapshot_offset_days))).alias("_snapshot"))
    return (with_scalars(per_user.where(F.col("user_uid").isNotNull()), snap)
            .withColumn("recency", F.timestamp_diff("DAY", F.col("last_order_date"), F.col("_snapshot")))
            .drop("_snapshot"))


def rfm_breaks(rfm: DataFrame, probs: list[float] = RFM_QUINTILES,
               materialized: bool = False) -> DataFrame:
    """Quintile breaks of recency, frequency and monetary (one row), all three refined together."""
    columns = ["recency", "frequency", "monetary"]
    rows = rfm.select(*columns)
    found = quantiles(rows if materialized else cut_lineage(rows), columns, probs)
    return one_row(rfm, **{f"{c}_breaks": found[c] for c in columns})


def quintile_score(x: Column, breaks: Column, reverse: bool = False) -> Column:
    """1..5 by ``<=`` against the breaks; recency reversed (low = 5).

    A null value fails every comparison and falls to the last branch.
    """
    scores = [5, 4, 3, 2] if reverse else [1, 2, 3, 4]
    out = None
    for i, s in enumerate(scores):
        cond = F.coalesce(x <= F.get(breaks, F.lit(i)), F.lit(False))
        out = F.when(cond, F.lit(s)) if out is None else out.when(cond, F.lit(s))
    return out.otherwise(F.lit(1 if reverse else 5))


def rfm_scores(rfm: DataFrame, breaks: DataFrame | None = None) -> DataFrame:
    """R/F/M scores and the concatenated code."""
    if breaks is None:
        # The per-user table feeds three jobs (count breaks, money sketch,
        # scoring): materialise it once in the shared checkpoint folder.
        rfm = cut_lineage(rfm)
        breaks = rfm_breaks(rfm, materialized=True)
    out = (with_scalars(rfm, breaks)
           .withColumn("R_score", quintile_score(F.col("recency"), F.col("recency_breaks"), True))
           .withColumn("F_score", quintile_score(F.col("frequency"), F.col("frequency_breaks")))
           .withColumn("M_score", quintile_score(F.col("monetary"), F.col("monetary_breaks")))
           .drop("recency_breaks", "frequency_breaks", "monetary_breaks"))
    return out.withColumn("RFM_score", F.concat(F.col("R_score").cast("string"),
                                                F.col("F_score").cast("string"),
                                                F.col("M_score").cast("string")))


def segment(r: Column, f: Column, m: Column) -> Column:
    """First matching rule of ``RFM_SEGMENTS``, else ``Others``."""
    out = None
    for name, (r_lo, r_hi), (f_lo, f_hi), (m_lo, m_hi) in RFM_SEGMENTS:
        cond = r.between(r_lo, r_hi) & f.between(f_lo, f_hi) & m.between(m_lo, m_hi)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(RFM_OTHER))


def rfm_segments(order_kpi: DataFrame) -> DataFrame:
    """The full RFM table."""
    s = rfm_scores(rfm_base(order_kpi))
    return s.withColumn("segment", segment(F.col("R_score"), F.col("F_score"), F.col("M_score")))


def segment_counts(rfm: DataFrame) -> DataFrame:
    """Users per segment."""
    return rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("num_users"))
