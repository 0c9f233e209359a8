"""Registered queries for KPIs, breakdowns, RFM and churn (E, F, G, H)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cartlens.catalog import register
from cartlens.oracles.views import money_sum as sql_money
from cartlens.oracles.views import sql
from cartlens.operators import breakdowns as bd
from cartlens.operators import churn, kpi, rfm
from cartlens.plans.etl import shop_clean, with_product_type
from cartlens.session import cut_lineage
from cartlens.sources import shop_tables as st

from cartlens.queries.common import AS_OF
from cartlens.queries.common import aged_profiles as _aged
from cartlens.queries.common import churn_features_of as _features
from cartlens.queries.common import customer_orders_of as _customer_orders
from cartlens.queries.common import order_kpi_of as _order_kpi


# ----------------------------------------------------------------- E: joins

@register("order_revenue", sql("SELECT * FROM order_rev", "order_rev"), money=("amount_paid_eur",))
def q_order_revenue(spark, sf):
    return kpi.order_revenue(shop_clean(spark, sf)["order_details"])


@register("orders_with_revenue", sql("""
SELECT o.*, r.amount_paid_eur FROM shop_orders o LEFT JOIN order_rev r ON o.order_uid = r.order_uid""",
                                     "shop_orders", "order_rev"), money=("amount_paid_eur",))
def q_orders_with_revenue(spark, sf):
    t = shop_clean(spark, sf)
    return kpi.orders_with_revenue(t["orders"], t["order_details"])


@register("customer_orders", sql("SELECT * FROM customer_orders", "customer_orders"), money=("amount_paid_eur",))
def q_customer_orders(spark, sf):
    return _customer_orders(spark, sf)


@register("order_kpi", sql("SELECT * FROM order_kpi", "order_kpi"), money=("order_revenue",))
def q_order_kpi(spark, sf):
    return _order_kpi(spark, sf)


@register("first_non_null_per_key", sql("SELECT * FROM user_profile", "user_profile"))
def q_first_non_null(spark, sf):
    return kpi.user_profile(shop_clean(spark, sf)["profiles"])


@register("churn_features", sql("SELECT * FROM churn_features", "churn_features"), money=("monetary_total", "avg_order_value",))
def q_churn_features(spark, sf):
    return _features(spark, sf)


@register("cents_to_units", """
SELECT o_orderkey AS order_uid, CAST(round(o_totalprice * 100) AS BIGINT) AS amount_paid,
       CAST(round(o_totalprice * 100) AS BIGINT) / CAST(100 AS DOUBLE) AS amount_paid_eur
FROM orders""")
def q_cents_to_units(spark, sf):
    o = st.table(spark, sf, "orders")
    cents = o.select(F.col("o_orderkey").alias("order_uid"),
                     F.round(F.col("o_totalprice") * 100).cast("long").alias("amount_paid"))
    return kpi.cents_to_units(cents)


# ------------------------------------------------------------ F: breakdowns

@register("revenue_by_city_top10", sql(f"""
SELECT city, {sql_money('amount_paid_eur')} AS revenue FROM customer_orders
WHERE city IS NOT NULL AND amount_paid_eur IS NOT NULL
GROUP BY city ORDER BY revenue DESC, city LIMIT 10""", "customer_orders"), money=("revenue",))
def q_revenue_by_city(spark, sf):
    return bd.revenue_by_city(_customer_orders(spark, sf))


@register("customers_by_city_top10", sql("""
SELECT city, count(DISTINCT user_uid) AS unique_customers FROM customer_orders
WHERE city IS NOT NULL GROUP BY city ORDER BY unique_customers DESC, city LIMIT 10""", "customer_orders"))
def q_customers_by_city(spark, sf):
    return bd.customers_by_city(_customer_orders(spark, sf))


@register("orders_per_customer_city", sql("""
SELECT city, total_orders, unique_customers, total_orders / unique_customers AS orders_per_customer
FROM (SELECT city, count(order_uid) AS total_orders, count(DISTINCT user_uid) AS unique_customers
      FROM customer_orders WHERE city IS NOT NULL GROUP BY city)
WHERE unique_customers > 50
ORDER BY orders_per_customer DESC, city LIMIT 10""", "customer_orders"))
def q_orders_per_customer_city(spark, sf):
    return bd.orders_per_customer_city(_customer_orders(spark, sf))


@register("orders_per_customer", sql("""
SELECT user_uid, count(*) AS num_orders FROM customer_orders
WHERE user_uid IS NOT NULL GROUP BY user_uid""", "customer_orders"))
def q_orders_per_customer(spark, sf):
    return bd.orders_per_customer(_customer_orders(spark, sf))


@register("one_time_vs_repeat", sql("""
SELECT count(*) AS total_customers,
       count(*) FILTER (WHERE n = 1) AS one_time_buyers,
       count(*) FILTER (WHERE n > 1) AS repeat_customers,
       (count(*) FILTER (WHERE n = 1)) / count(*) AS one_time_share,
       (count(*) FILTER (WHERE n > 1)) / count(*) AS repeat_share
FROM (SELECT user_uid, count(*) AS n FROM customer_orders WHERE user_uid IS NOT NULL GROUP BY user_uid)""",
                                    "customer_orders"))
def q_one_time_vs_repeat(spark, sf):
    return bd.one_time_vs_repeat(bd.orders_per_customer(_customer_orders(spark, sf)))


_AGE_SQL = f"CAST(floor(date_sub('day', birthday, TIMESTAMP '{AS_OF}') / 365) AS BIGINT)"


@register("age_years", sql(f"""
SELECT profile_uid, user_uid, birthday, sex, city, level, {_AGE_SQL} AS age FROM profiles""", "profiles"))
def q_age_years(spark, sf):
    return _aged(spark, sf)


@register("age_stats", sql(f"""
SELECT round(avg(age), 6) AS mean_age, median(age) AS median_age
FROM (SELECT {_AGE_SQL} AS age FROM profiles)""", "profiles"))
def q_age_stats(spark, sf):
    s = bd.age_stats(_aged(spark, sf))
    return s.select(F.round("mean_age", 6).alias("mean_age"), "median_age")


@register("age_modes", sql(f"""
WITH c AS (SELECT age, count(*) AS num_profiles FROM (SELECT {_AGE_SQL} AS age FROM profiles)
           WHERE age IS NOT NULL GROUP BY age)
SELECT age, num_profiles FROM c WHERE num_profiles = (SELECT max(num_profiles) FROM c)""", "profiles"))
def q_age_modes(spark, sf):
    return bd.age_modes(_aged(spark, sf))


@register("age_histogram", sql(f"""
WITH a AS (SELECT CAST({_AGE_SQL} AS DOUBLE) AS x FROM profiles),
     ages AS (SELECT x FROM a WHERE x IS NOT NULL),
     rng AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / CAST(30 AS DOUBLE) AS step FROM ages),
     t AS (SELECT x, lo, step,
                  CAST(coalesce(least(floor((x - lo) * CAST(30 AS DOUBLE) / (hi - lo)), 29), 0) AS BIGINT) AS b
           FROM ages, rng),
     f AS (SELECT CASE WHEN x < lo + b * step THEN b - 1
                       WHEN x >= lo + (b + 1) * step AND b < 29 THEN b + 1 ELSE b END AS bin
           FROM t),
     c AS (SELECT bin, count(*) AS num_profiles FROM f GROUP BY bin)
SELECT g.bin, round(r.lo + g.bin * r.step, 6) AS bin_start, round(r.lo + (g.bin + 1) * r.step, 6) AS bin_end,
       coalesce(c.num_profiles, 0) AS num_profiles
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(0, 30)) g CROSS JOIN rng r
LEFT JOIN c ON g.bin = c.bin""", "profiles"))
def q_age_histogram(spark, sf):
    return bd.age_histogram(_aged(spark, sf))


@register("age_density", sql(f"""
WITH a AS (SELECT CAST({_AGE_SQL} AS DOUBLE) AS age FROM profiles),
     c AS (SELECT age AS a, count(*) AS c FROM a WHERE age IS NOT NULL GROUP BY age),
     s AS (SELECT count(*) AS n, stddev_samp(age) AS sd, min(age) AS lo, max(age) AS hi
           FROM a WHERE age IS NOT NULL),
     s2 AS (SELECT n, lo, hi, sd * pow(n, -0.2) AS h FROM s),
     g AS (SELECT CAST(range AS INTEGER) AS grid_index,
                  lo + (hi - lo) * range / CAST(199 AS DOUBLE) AS x, n, h
           FROM range(0, 200), s2)
SELECT g.grid_index, round(g.x, 6) AS age,
       round(sum(c.c * exp(-0.5 * ((g.x - c.a) / g.h) * ((g.x - c.a) / g.h)))
             / (g.n * g.h * {math.sqrt(2 * math.pi)!r}), 9) AS density
FROM g CROSS JOIN c GROUP BY g.grid_index, g.x, g.n, g.h""", "profiles"))
def q_age_density(spark, sf):
    return bd.age_density(_aged(spark, sf))


@register("share_sex", sql("""
SELECT sex, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
FROM profiles WHERE sex IS NOT NULL GROUP BY sex""", "profiles"))
def q_share_sex(spark, sf):
    return bd.share_pct(shop_clean(spark, sf)["profiles"], "sex")


@register("revenue_by_product_type", sql(f"""
SELECT p.product_type, {sql_money('d.item_amount')} AS revenue
FROM details d LEFT JOIN products p ON d.product_uid = p.product_uid
WHERE d.item_status = 'fulfilled' AND p.product_type IS NOT NULL
GROUP BY p.product_type""", "details", "products"), money=("revenue",))
def q_revenue_by_product_type(spark, sf):
    d = with_product_type(shop_clean(spark, sf)["order_details"], st.products(spark, sf))
    return bd.revenue_by_product_type(d)


@register("revenue_by_source", sql(f"""
SELECT order_source, coalesce({sql_money('amount_paid_eur')}, 0.0) AS revenue
FROM customer_orders WHERE order_source IS NOT NULL GROUP BY order_source""", "customer_orders"), money=("revenue",))
def q_revenue_by_source(spark, sf):
    co = _customer_orders(spark, sf)
    return bd.revenue_by_source(co)


@register("share_registration_source", sql("""
SELECT source, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
FROM users WHERE source IS NOT NULL GROUP BY source""", "users"))
def q_share_registration_source(spark, sf):
    return bd.share_pct(shop_clean(spark, sf)["users"], "source")


@register("order_volume_monthly", sql("""
WITH c AS (SELECT last_day(created_at) AS p, count(*) AS num_orders FROM shop_orders
           WHERE created_at IS NOT NULL GROUP BY 1),
     r AS (SELECT min(p) AS lo, max(p) AS hi FROM c),
     g AS (SELECT last_day(m) AS p FROM (
             SELECT unnest(generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP),
                                           CAST(date_trunc('month', hi) AS TIMESTAMP),
                                           INTERVAL 1 MONTH)) AS m FROM r))
SELECT CAST(g.p AS TIMESTAMP) AS period_end, coalesce(c.num_orders, 0) AS num_orders
FROM g LEFT JOIN c ON g.p = c.p""", "shop_orders"))
def q_order_volume(spark, sf):
    return bd.order_volume(shop_clean(spark, sf)["orders"], "created_at", "month")


@register("revenue_by_product_type_top10", sql(f"""
SELECT p.product_type, {sql_money('d.item_amount')} AS revenue
FROM details d LEFT JOIN products p ON d.product_uid = p.product_uid
WHERE d.item_status = 'fulfilled' AND p.product_type IS NOT NULL
GROUP BY p.product_type ORDER BY revenue DESC, p.product_type LIMIT 10""", "details", "products"), money=("revenue",))
def q_revenue_by_product_type_top10(spark, sf):
    d = with_product_type(shop_clean(spark, sf)["order_details"], st.products(spark, sf))
    return bd.revenue_by_product_type(d, k=10)


def _volume_sql(label: str, step: str) -> str:
    return sql(f"""
WITH c AS (SELECT {label} AS p, count(*) AS num_orders FROM shop_orders WHERE created_at IS NOT NULL GROUP BY 1),
     g AS (SELECT CAST(unnest(generate_series(CAST((SELECT min(p) FROM c) AS TIMESTAMP),
                                              CAST((SELECT max(p) FROM c) AS TIMESTAMP), INTERVAL {step})) AS DATE) AS p)
SELECT CAST(g.p AS TIMESTAMP) AS period_end, coalesce(c.num_orders, 0) AS num_orders
FROM g LEFT JOIN c ON g.p = c.p""", "shop_orders")


@register("order_volume_weekly", _volume_sql("CAST(date_trunc('week', created_at) AS DATE) + 6", "7 DAY"))
def q_order_volume_weekly(spark, sf):
    return bd.order_volume(shop_clean(spark, sf)["orders"], "created_at", "week")


@register("order_volume_daily", _volume_sql("CAST(created_at AS DATE)", "1 DAY"))
def q_order_volume_daily(spark, sf):
    return bd.order_volume(shop_clean(spark, sf)["orders"], "created_at", "day")


@register("top_languages", sql("""
SELECT language, count(*) AS num_users FROM users WHERE language IS NOT NULL
GROUP BY language ORDER BY num_users DESC, language LIMIT 10""", "users"))
def q_top_languages(spark, sf):
    return bd.top_values(shop_clean(spark, sf)["users"], "language")


# ------------------------------------------------------------------- G: RFM

@register("rfm_base", sql("SELECT * FROM rfm_base", "rfm_base"), money=("monetary",))
def q_rfm_base(spark, sf):
    return rfm.rfm_base(_order_kpi(spark, sf))


_BREAK_COLS = ",\n       ".join(f"round({src}_breaks[{i + 1}], 6) AS {src[0]}{q}"
                                for src in ("recency", "frequency", "monetary")
                                for i, q in enumerate((20, 40, 60, 80)))


@register("rfm_breaks", sql(f"""
SELECT {_BREAK_COLS}
FROM rfm_breaks""", "rfm_breaks"))
def q_rfm_breaks(spark, sf):
    b = rfm.rfm_breaks(rfm.rfm_base(_order_kpi(spark, sf)))
    cols = []
    for src in ("recency", "frequency", "monetary"):
        for i, q in enumerate((20, 40, 60, 80)):
            cols.append(F.round(F.col(f"{src}_breaks")[i], 6).alias(f"{src[0]}{q}"))
    return b.select(*cols)


@register("rfm_scores", sql("""
SELECT user_uid, recency, frequency, monetary, R_score, F_score, M_score,
       CAST(R_score AS VARCHAR) || CAST(F_score AS VARCHAR) || CAST(M_score AS VARCHAR) AS RFM_score
FROM rfm_scores""", "rfm_scores"), money=("monetary",))
def q_rfm_scores(spark, sf):
    s = rfm.rfm_scores(rfm.rfm_base(_order_kpi(spark, sf)))
    return s.select("user_uid", "recency", "frequency", "monetary", "R_score", "F_score", "M_score",
                    "RFM_score")


@register("rfm_segments", sql("SELECT * FROM rfm", "rfm"), money=("monetary",))
def q_rfm_segments(spark, sf):
    return rfm.rfm_segments(_order_kpi(spark, sf))


@register("rfm_segment_counts", sql("SELECT segment, count(*) AS num_users FROM rfm GROUP BY segment", "rfm"))
def q_rfm_segment_counts(spark, sf):
    return rfm.segment_counts(rfm.rfm_segments(_order_kpi(spark, sf)))


# ----------------------------------------------------------------- H: churn

@register("orders_after_cutoff", sql("""
SELECT k.* FROM order_kpi k, cut c
WHERE k.order_date >= c.cutoff_date AND k.order_date <= c.snapshot_date""", "order_kpi", "cut"), money=("order_revenue",))
def q_orders_after_cutoff(spark, sf):
    ok = cut_lineage(_order_kpi(spark, sf))
    return churn.orders_after_cutoff(ok, churn.cutoff(ok))


@register("churn_labels", sql("SELECT * FROM churn_labels", "churn_labels"))
def q_churn_labels(spark, sf):
    ok = cut_lineage(_order_kpi(spark, sf))
    return churn.churn_labels(ok, churn.cutoff(ok))


@register("churn_distribution", sql("""
SELECT churned, count(*) AS num_users, CASE WHEN churned = 1 THEN 'Churned' ELSE 'Active' END AS status
FROM churn_labels GROUP BY churned""", "churn_labels"))
def q_churn_distribution(spark, sf):
    ok = cut_lineage(_order_kpi(spark, sf))
    return churn.churn_distribution(churn.churn_labels(ok, churn.cutoff(ok)))


@register("behavior_features", sql("SELECT * FROM behavior", "behavior"), money=("monetary_total", "avg_order_value",))
def q_behavior_features(spark, sf):
    ok = cut_lineage(_order_kpi(spark, sf))
    return churn.behavior_features(ok, churn.cutoff(ok))
