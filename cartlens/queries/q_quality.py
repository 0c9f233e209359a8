"""Registered queries for data-quality checks and repairs (C, D)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.catalog import register
from cartlens.functions.text import clean_str
from cartlens.oracles.views import EMPTY_CARD, clean, in_list, sql
from cartlens.operators import check_suite
from cartlens.operators import quality as dq
from cartlens.operators import repair
from cartlens.operators.check_suite import Check
from cartlens.plans.etl import clean_users, shop_clean
from cartlens.schema import CARD_NOT_ASSIGNED, CARD_STATUSES, ITEM_STATUSES
from cartlens.sources import shop_tables as st


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _tag(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), *df.columns)


def _users(spark, sf):
    return clean_users(st.raw_users(spark, sf))


def _cards_status(spark, sf):
    return st.raw_cards(spark, sf).withColumn("status", clean_str("status", "lower"))


def _cards_latest(spark, sf):
    return repair.latest_per_key(_cards_status(spark, sf), "card_uid", "assigned_at", "event_id")


def _cards_fk(spark, sf):
    return repair.fk_conditional(_cards_latest(spark, sf), _users(spark, sf), "user_uid", "user_uid",
                                 "status", CARD_NOT_ASSIGNED)


def _details_status(spark, sf):
    return st.raw_order_details(spark, sf).withColumn("item_status", clean_str("item_status", "lower"))


def _details_domain(spark, sf):
    return repair.domain_filter(_details_status(spark, sf), "item_status", ITEM_STATUSES)


def _details_fk(spark, sf):
    return repair.fk_strict(_details_domain(spark, sf), shop_clean(spark, sf)["orders"],
                            "order_uid", "order_uid")


# ------------------------------------------------------------------ C checks

SUITE = [
    Check("cards.card_uid null", "null_key", "cards", ("card_uid",)),
    Check("profiles.user_uid null", "null_key", "profiles", ("user_uid",)),
    Check("cards.card_uid repeated", "duplicate", "cards", ("card_uid",)),
    Check("details key repeated", "duplicate", "order_details", ("order_uid", "item_uid", "item_status")),
    Check("profiles->users", "foreign_key", "profiles", ("user_uid",), ("users", "user_uid")),
    Check("orders->users", "foreign_key", "orders", ("user_uid",), ("users", "user_uid")),
    Check("details->orders", "foreign_key", "order_details", ("order_uid",), ("orders", "order_uid")),
    Check("reviews->users", "foreign_key", "reviews", ("user_uid",), ("users", "user_uid")),
    Check("cards->users if assigned", "foreign_key", "cards", ("user_uid",), ("users", "user_uid"), ("status", CARD_NOT_ASSIGNED)),
    Check("cards.status", "domain", "cards", ("status",), values=tuple(CARD_STATUSES)),
    Check("details.item_status", "domain", "order_details", ("item_status",), values=tuple(ITEM_STATUSES)),
    Check("details.item_amount missing", "missing", "order_details", ("item_amount",)),
    Check("details.item_amount negative", "negative", "order_details", ("item_amount",)),
    Check("cards empty", "empty", "cards", ("status", "user_uid", "assigned_at", "birthday"), values=(CARD_NOT_ASSIGNED,)),
]


def _suite_sql() -> str:
    def plain(name, table, cond, key="CAST(NULL AS VARCHAR)"):
        return f"SELECT '{name}' AS check_name, count(DISTINCT {key}) AS bad_keys, count(*) AS bad_rows, 0 AS matched_keys, 0 AS matched_pairs FROM {table} WHERE {cond}"

    def repeated(name, table, by):
        return f"""SELECT '{name}', count(k), coalesce(sum(n), 0), 0, 0
FROM (SELECT {'any_value(' + by + ')' if ',' not in by else '1'} AS k, count(*) AS n FROM {table} GROUP BY {by} HAVING count(*) > 1)"""

    def reference(name, child, key, parent, cond="true"):
        p = f"(SELECT {key} AS k, count(*) AS m FROM {parent} GROUP BY 1)"
        return f"""SELECT '{name}', count(DISTINCT c.{key}) FILTER (WHERE m IS NULL), count(*) FILTER (WHERE m IS NULL),
  count(DISTINCT c.{key}) FILTER (WHERE m IS NOT NULL), (SELECT coalesce(sum(m), 0) FROM {p} WHERE k IN (SELECT {key} FROM {child} WHERE {cond}))
FROM (SELECT * FROM {child} WHERE {cond}) c LEFT JOIN {p} p ON c.{key} = p.k"""

    details = f"(SELECT * REPLACE ({clean('item_status', 'lower')} AS item_status) FROM raw_details)"
    assigned = f"status IS DISTINCT FROM '{CARD_NOT_ASSIGNED}'"
    parts = [
        plain("cards.card_uid null", "cards_status", "card_uid IS NULL"), plain("profiles.user_uid null", "raw_profiles", "user_uid IS NULL"),
        repeated("cards.card_uid repeated", "cards_status", "card_uid"),
        repeated("details key repeated", details, "order_uid, item_uid, item_status"),
        reference("profiles->users", "raw_profiles", "user_uid", "users"), reference("orders->users", "raw_orders", "user_uid", "users"),
        reference("details->orders", "raw_details", "order_uid", "raw_orders"), reference("reviews->users", "raw_reviews", "user_uid", "users"),
        reference("cards->users if assigned", "cards_status", "user_uid", "users", assigned),
        plain("cards.status", "cards_status", f"NOT coalesce(status IN {in_list(CARD_STATUSES)}, false)", "status"),
        plain("details.item_status", details, f"NOT coalesce(item_status IN {in_list(ITEM_STATUSES)}, false)", "item_status"),
        plain("details.item_amount missing", "raw_details", "item_amount IS NULL"),
        plain("details.item_amount negative", "raw_details", "item_amount < 0"), plain("cards empty", "cards_status", EMPTY_CARD)]
    body = "\nUNION ALL ".join(parts)
    return sql(f"""SELECT check_name, CAST(bad_keys AS BIGINT) AS bad_keys, CAST(bad_rows AS BIGINT) AS bad_rows,
  CAST(matched_keys AS BIGINT) AS matched_keys, CAST(matched_pairs AS BIGINT) AS matched_pairs FROM ({body})""",
               "cards_status", "raw_profiles", "users", "raw_orders", "raw_details", "raw_reviews")


@register("check_suite", _suite_sql())
def q_check_suite(spark, sf):
    """C1-C12 in one pass over each table."""
    return check_suite.report(_suite_tables(spark, sf), SUITE)


def _suite_tables(spark, sf):
    return {"users": st.raw_users(spark, sf), "profiles": st.raw_profiles(spark, sf), "cards": _cards_status(spark, sf),
            "orders": st.raw_orders(spark, sf), "order_details": _details_status(spark, sf), "reviews": st.raw_reviews(spark, sf)}


@register("dq_null_key", sql("""
SELECT 'cards.card_uid' AS check_name, count(*) FILTER (WHERE card_uid IS NULL) AS null_keys FROM raw_cards
UNION ALL SELECT 'profiles.user_uid', count(*) FILTER (WHERE user_uid IS NULL) FROM raw_profiles
UNION ALL SELECT 'reviews.user_uid', count(*) FILTER (WHERE user_uid IS NULL) FROM raw_reviews
UNION ALL SELECT 'orders.order_uid', count(*) FILTER (WHERE order_uid IS NULL) FROM raw_orders""",
                             "raw_cards", "raw_profiles", "raw_reviews", "raw_orders"))
def q_dq_null_key(spark, sf):
    return _union([
        _tag(dq.null_key_count(st.raw_cards(spark, sf), "card_uid"), "cards.card_uid"),
        _tag(dq.null_key_count(st.raw_profiles(spark, sf), "user_uid"), "profiles.user_uid"),
        _tag(dq.null_key_count(st.raw_reviews(spark, sf), "user_uid"), "reviews.user_uid"),
        _tag(dq.null_key_count(st.raw_orders(spark, sf), "order_uid"), "orders.order_uid"),
    ])


@register("dq_duplicate_key", sql("""
SELECT card_uid, count(*) AS num_rows FROM raw_cards GROUP BY card_uid HAVING count(*) > 1""", "raw_cards"))
def q_dq_duplicate_key(spark, sf):
    return dq.duplicate_keys(st.raw_cards(spark, sf), "card_uid")


@register("dq_duplicate_key_after_latest", sql("""
SELECT card_uid, count(*) AS num_rows FROM cards_latest GROUP BY card_uid HAVING count(*) > 1""",
                                               "cards_latest"))
def q_dq_duplicate_key_after(spark, sf):
    return dq.duplicate_keys(_cards_latest(spark, sf), "card_uid")


@register("dq_duplicate_composite", sql(f"""
SELECT order_uid, item_uid, item_status, count(*) AS num_rows
FROM (SELECT order_uid, item_uid, {clean('item_status', 'lower')} AS item_status FROM raw_details)
GROUP BY order_uid, item_uid, item_status HAVING count(*) > 1""", "raw_details"))
def q_dq_duplicate_composite(spark, sf):
    return dq.duplicate_keys(_details_status(spark, sf), ["order_uid", "item_uid", "item_status"])


@register("dq_fk_coverage", sql("""
SELECT in_parent, count(*) AS num_rows
FROM (SELECT a.user_uid, b.in_parent
      FROM (SELECT DISTINCT user_uid FROM raw_profiles WHERE user_uid IS NOT NULL) a
      LEFT JOIN (SELECT user_uid, 1.0::DOUBLE AS in_parent FROM users) b ON a.user_uid = b.user_uid)
GROUP BY in_parent HAVING count(*) > 1""", "raw_profiles", "users"))
def q_dq_fk_coverage(spark, sf):
    return dq.fk_coverage(st.raw_profiles(spark, sf), _users(spark, sf), "user_uid", "user_uid")


@register("dq_fk_orphan_keys", sql("""
SELECT DISTINCT user_uid FROM raw_profiles
WHERE user_uid IS NOT NULL AND user_uid NOT IN (SELECT user_uid FROM users)""", "raw_profiles", "users"))
def q_dq_fk_orphan_keys(spark, sf):
    return dq.fk_orphan_keys(st.raw_profiles(spark, sf), _users(spark, sf), "user_uid", "user_uid")


@register("dq_fk_orphan_rows", sql("""
SELECT * FROM raw_profiles
WHERE user_uid IS NOT NULL AND user_uid NOT IN (SELECT user_uid FROM users)""", "raw_profiles", "users"))
def q_dq_fk_orphan_rows(spark, sf):
    return dq.fk_orphan_rows(st.raw_profiles(spark, sf), _users(spark, sf), "user_uid", "user_uid")


@register("dq_fk_violation_count", sql(f"""
SELECT 'orders->users' AS check_name, count(*) AS violations FROM raw_orders
WHERE NOT coalesce(user_uid IN (SELECT user_uid FROM users), false)
UNION ALL
SELECT 'details->orders (before)', count(*) FROM (SELECT * FROM raw_details WHERE
  {clean('item_status', 'lower')} IN {in_list(ITEM_STATUSES)})
WHERE NOT coalesce(order_uid IN (SELECT order_uid FROM shop_orders), false)
UNION ALL
SELECT 'details->orders (after)', count(*) FROM details
WHERE NOT coalesce(order_uid IN (SELECT order_uid FROM shop_orders), false)
UNION ALL
SELECT 'reviews->users', count(*) FROM raw_reviews
WHERE NOT coalesce(user_uid IN (SELECT user_uid FROM users), false)""",
                                         "raw_orders", "users", "raw_details", "shop_orders", "details",
                                         "raw_reviews"))
def q_dq_fk_violation_count(spark, sf):
    users = _users(spark, sf)
    orders = shop_clean(spark, sf)["orders"]
    return _union([
        _tag(dq.fk_violation_count(st.raw_orders(spark, sf), users, "user_uid", "user_uid"), "orders->users"),
        _tag(dq.fk_violation_count(_details_domain(spark, sf), orders, "order_uid", "order_uid"),
             "details->orders (before)"),
        _tag(dq.fk_violation_count(shop_clean(spark, sf)["order_details"], orders, "order_uid", "order_uid"),
             "details->orders (after)"),
        _tag(dq.fk_violation_count(st.raw_reviews(spark, sf), users, "user_uid", "user_uid"), "reviews->users"),
    ])


@register("dq_conditional_fk", sql("""
SELECT 'before' AS check_name, count(*) AS violations FROM cards_latest
WHERE status IS DISTINCT FROM 'not-assigned' AND NOT coalesce(user_uid IN (SELECT user_uid FROM users), false)
UNION ALL
SELECT 'after', count(*) FROM cards_fk
WHERE status IS DISTINCT FROM 'not-assigned' AND NOT coalesce(user_uid IN (SELECT user_uid FROM users), false)""",
                                   "cards_latest", "cards_fk", "users"))
def q_dq_conditional_fk(spark, sf):
    users = _users(spark, sf)
    return _union([
        _tag(dq.conditional_fk_count(_cards_latest(spark, sf), users, "user_uid", "user_uid", "status",
                                     CARD_NOT_ASSIGNED), "before"),
        _tag(dq.conditional_fk_count(_cards_fk(spark, sf), users, "user_uid", "user_uid", "status",
                                     CARD_NOT_ASSIGNED), "after"),
    ])


@register("dq_domain", sql(f"""
SELECT 'cards.status' AS check_name,
       count(*) FILTER (WHERE NOT coalesce(status IN {in_list(CARD_STATUSES)}, false)) AS violations
FROM cards_latest
UNION ALL
SELECT 'order_details.item_status (before)',
       count(*) FILTER (WHERE NOT coalesce(s IN {in_list(ITEM_STATUSES)}, false))
FROM (SELECT {clean('item_status', 'lower')} AS s FROM raw_details)
UNION ALL
SELECT 'order_details.item_status (after)',
       count(*) FILTER (WHERE NOT coalesce(item_status IN {in_list(ITEM_STATUSES)}, false))
FROM details""", "cards_latest", "raw_details", "details"))
def q_dq_domain(spark, sf):
    return _union([
        _tag(dq.domain_violations(_cards_latest(spark, sf), "status", CARD_STATUSES), "cards.status"),
        _tag(dq.domain_violations(_details_status(spark, sf), "item_status", ITEM_STATUSES),
             "order_details.item_status (before)"),
        _tag(dq.domain_violations(shop_clean(spark, sf)["order_details"], "item_status", ITEM_STATUSES),
             "order_details.item_status (after)"),
    ])


@register("dq_numeric_range", sql(f"""
WITH before AS (
  SELECT * FROM (SELECT order_uid, {clean('item_status', 'lower')} AS item_status, item_amount FROM raw_details)
  WHERE item_status IN {in_list(ITEM_STATUSES)} AND order_uid IN (SELECT order_uid FROM shop_orders))
SELECT 'before' AS check_name, count(*) FILTER (WHERE item_amount IS NULL) AS missing,
       count(*) FILTER (WHERE item_amount < 0) AS negative FROM before
UNION ALL
SELECT 'after', count(*) FILTER (WHERE item_amount IS NULL), count(*) FILTER (WHERE item_amount < 0)
FROM details""", "raw_details", "shop_orders", "details"))
def q_dq_numeric_range(spark, sf):
    return _union([
        _tag(dq.numeric_range(_details_fk(spark, sf), "item_amount"), "before"),
        _tag(dq.numeric_range(shop_clean(spark, sf)["order_details"], "item_amount"), "after"),
    ])


@register("dq_empty_rows", sql(f"""
SELECT count(*) FILTER (WHERE {EMPTY_CARD}) AS empty_rows FROM cards_fk""", "cards_fk"))
def q_dq_empty_rows(spark, sf):
    return dq.empty_row_count(_cards_fk(spark, sf), "status", CARD_NOT_ASSIGNED, "user_uid",
                              ["assigned_at", "birthday"])


# ----------------------------------------------------------------- D repairs

@register("repair_fk_keep_null", sql("SELECT * FROM profiles", "profiles"))
def q_repair_fk_keep_null(spark, sf):
    return shop_clean(spark, sf)["profiles"]


@register("repair_fk_strict", sql("SELECT * FROM shop_orders", "shop_orders"))
def q_repair_fk_strict(spark, sf):
    return shop_clean(spark, sf)["orders"]


@register("repair_fk_conditional", sql("SELECT * FROM cards_fk", "cards_fk"))
def q_repair_fk_conditional(spark, sf):
    return _cards_fk(spark, sf)


@register("latest_per_key", sql("SELECT * FROM cards_latest", "cards_latest"))
def q_latest_per_key(spark, sf):
    return _cards_latest(spark, sf)


@register("drop_empty_rows", sql("SELECT * FROM cards", "cards"))
def q_drop_empty_rows(spark, sf):
    return shop_clean(spark, sf)["cards"]


@register("repair_domain", sql(f"""
SELECT * FROM (SELECT order_uid, item_uid, {clean('item_status', 'lower')} AS item_status, item_date,
                      product_uid, item_amount FROM raw_details)
WHERE item_status IN {in_list(ITEM_STATUSES)}""", "raw_details"))
def q_repair_domain(spark, sf):
    return _details_domain(spark, sf)


@register("repair_non_negative", sql("SELECT * FROM details", "details"))
def q_repair_non_negative(spark, sf):
    return shop_clean(spark, sf)["order_details"]
