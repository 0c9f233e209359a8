"""The analysis and RFM notebooks as one call each.

``analysis_report`` returns every breakdown table of the data-analysis
notebook (the tables behind its charts); ``rfm_report`` returns the RFM table
and the segment counts. Both are lazy except for the checkpoints the
operators take themselves; ``write_report`` persists any of them as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.operators import breakdowns as bd
from cartlens.operators import kpi, rfm
from cartlens.session import cut_lineage


def analysis_report(tables: dict[str, DataFrame], as_of: str | None = None,
                    products: DataFrame | None = None) -> dict[str, DataFrame]:
    """F1-F16 over clean entity tables (users, profiles, orders, order_details)."""
    users = tables["users"]
    co = kpi.customer_orders(kpi.orders_with_revenue(tables["orders"], tables["order_details"]), users)
    aged = bd.with_age(tables["profiles"], as_of)
    per_customer = bd.orders_per_customer(co)
    out = {
        "revenue_by_city_top10": bd.revenue_by_city(co),
        "customers_by_city_top10": bd.customers_by_city(co),
        "orders_per_customer_city": bd.orders_per_customer_city(co),
        "orders_per_customer": per_customer,
        "one_time_vs_repeat": bd.one_time_vs_repeat(per_customer),
        "age_stats": bd.age_stats(aged),
        "age_modes": bd.age_modes(aged),
        "age_histogram": bd.age_histogram(aged),
        "age_density": bd.age_density(aged),
        "share_sex": bd.share_pct(tables["profiles"], "sex"),
        "revenue_by_source": bd.revenue_by_source(co),
        "share_registration_source": bd.share_pct(users, "source"),
        "order_volume_monthly": bd.order_volume(tables["orders"]),
        "top_languages": bd.top_values(users, "language"),
    }
    details = tables["order_details"]
    if "product_type" not in details.columns and products is not None:
        from cartlens.plans.etl import with_product_type
        details = with_product_type(details, products)
    if "product_type" in details.columns:
        out["revenue_by_product_type"] = bd.revenue_by_product_type(details)
    # A report shows money in cents.
    return {name: df.withColumn("revenue", F.round("revenue", 2)) if "revenue" in df.columns else df
            for name, df in out.items()}


def rfm_report(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The RFM table (checkpointed: the counts are computed from it) and
    users per segment."""
    table = cut_lineage(rfm.rfm_segments(kpi.order_kpi(tables["orders"], tables["order_details"])))
    return {"rfm": table, "segment_counts": rfm.segment_counts(table)}


def write_report(frames: dict[str, DataFrame], out_dir: str) -> None:
    """Persist each table as Parquet under ``out_dir/<name>``."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
