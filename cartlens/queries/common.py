"""Inputs shared by several registered queries (built lazily per call)."""

from __future__ import annotations

from cartlens.operators import breakdowns as bd
from cartlens.operators import churn, kpi
from cartlens.plans.etl import shop_clean
from cartlens.session import cut_lineage

AS_OF = "2024-01-01"  # fixed "now" for age queries, so results are reproducible


def order_kpi_of(spark, sf):
    t = shop_clean(spark, sf)
    return kpi.order_kpi(t["orders"], t["order_details"])


def customer_orders_of(spark, sf):
    t = shop_clean(spark, sf)
    users = t["users"].select("user_uid", "created_at", "source", "city", "language")
    return kpi.customer_orders(kpi.orders_with_revenue(t["orders"], t["order_details"]), users)


def aged_profiles(spark, sf):
    return bd.with_age(shop_clean(spark, sf)["profiles"], AS_OF)


def churn_features_of(spark, sf):
    t = shop_clean(spark, sf)
    # Read by the cut-off, the labels and the features: run the order pipeline once.
    ok = cut_lineage(kpi.order_kpi(t["orders"], t["order_details"]))
    cut = churn.cutoff(ok)
    users = t["users"].select("user_uid", "created_at", "source", "city", "language")
    return kpi.churn_features(churn.behavior_features(ok, cut), churn.churn_labels(ok, cut),
                              users, kpi.user_profile(t["profiles"]))
