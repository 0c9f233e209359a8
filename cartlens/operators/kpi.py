"""Joins and derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.operators.stats import money_sum
from cartlens.schema import FULFILLED


def order_revenue(details: DataFrame, order: str = "order_uid", amount: str = "item_amount",
                  name: str = "amount_paid_eur") -> DataFrame:
    """Revenue per order over all (valid) item statuses; null order dropped."""
    return (details.where(F.col(order).isNotNull())
            .groupBy(order).agg(money_sum(amount).alias(name)))


def orders_with_revenue(orders: DataFrame, details: DataFrame,
                        name: str = "amount_paid_eur") -> DataFrame:
    """Orders left-joined to their revenue; itemless orders get null.

    The item side is reduced to one row per order before the join, so the
    shuffle carries one row per order, not per item.
    """
    return orders.join(order_revenue(details, name=name), "order_uid", "left")


def customer_orders(orders_rev: DataFrame, users: DataFrame,
                    user_columns: list[str] | None = None, null_safe: bool = False) -> DataFrame:
    """Orders left-joined to users on ``user_uid``.

    Names shared by both sides get explicit prefixes: ``order_*`` for the
    order's, ``user_*`` for the user's (the reference's ``_x`` / ``_y``).
    ``null_safe`` also matches a null user with a null user (pandas merge
    semantics); the default is plain equality.
    """
    ucols = [c for c in (user_columns or users.columns) if c != "user_uid"]
    clash = set(ucols) & (set(orders_rev.columns) - {"user_uid"})
    o = orders_rev.select(*[F.col(c).alias(f"order_{c}" if c in clash else c)
                            for c in orders_rev.columns])
    u = users.select("user_uid", *[F.col(c).alias(f"user_{c}" if c in clash else c) for c in ucols])
    if null_safe:
        u = u.withColumnRenamed("user_uid", "_u")
        return o.join(u, o["user_uid"].eqNullSafe(u["_u"]), "left").drop("_u")
    return o.join(u, "user_uid", "left")


def order_kpi(orders: DataFrame, details: DataFrame, status: str = FULFILLED) -> DataFrame:
    """E4+E5: one row per order with a fulfilled item: user, date, source,
    tenant, and the revenue of its fulfilled items.

    Items are aggregated to order grain first (partial aggregation on the
    map side), then joined to orders; both sides are keyed by ``order_uid``.
    ``order_uid`` must be unique in ``orders`` (check with
    :func:`cartlens.operators.quality.duplicate_keys`).
    """
    rev = (details.where((F.col("item_status") == status) & F.col("order_uid").isNotNull())
           .groupBy("order_uid").agg(money_sum("item_amount").alias("order_revenue")))
    o = orders.select("order_uid", "user_uid", F.col("created_at").alias("order_date"),
                      "source", "tenant")
    return (rev.join(o, "order_uid", "left")
            .select("order_uid", "user_uid", "order_date", "source", "tenant", "order_revenue"))


def first_non_null_per_key(df: DataFrame, key: str, columns: list[str], order: str,
                           renames: dict[str, str] | None = None) -> DataFrame:
    """Per key, each column's first non-null value in ``order`` order.

    Columns are independent (the first city may come from another row than
    the first sex). ``min_by`` ignores rows whose ordering value is null, so
    ordering by ``when(c is not null, order)`` skips nulls. It is an
    aggregate with a map-side partial step (sorted there, as strings do not fit
    a hash aggregate's buffer), safe for hot keys.
    """
    renames = renames or {}
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(renames.get(c, c))
            for c in columns]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def user_profile(profiles: DataFrame, order: str = "profile_uid") -> DataFrame:
    """One profile row per user: main_city, sex, level (first non-null each)."""
    return first_non_null_per_key(profiles, "user_uid", ["city", "sex", "level"], order,
                                  {"city": "main_city"})


def churn_features(behavior: DataFrame, labels: DataFrame, users: DataFrame,
                   profile: DataFrame) -> DataFrame:
    """Behaviour ⋈ label (inner) ⟕ users ⟕ user profile, all on ``user_uid``."""
    return (behavior.join(labels.select("user_uid", "churned"), "user_uid", "inner")
            .join(users, "user_uid", "left")
            .join(profile, "user_uid", "left"))


def cents_to_units(df: DataFrame, column: str = "amount_paid", name: str = "amount_paid_eur",
                   divisor: float = 100.0) -> DataFrame:
    """``name = column / 100`` when ``column`` exists; otherwise unchanged."""
    if column not in df.columns:
        return df
    return df.withColumn(name, F.col(column) / F.lit(divisor))
