"""The shop entities as DuckDB SQL (common table expressions).

SQL twin of :mod:`cartlens.sources.shop_tables` and :mod:`cartlens.plans.etl`, used by
``oracle_sql()``. It shares the fixed values of :mod:`cartlens.schema` with the engine. ``sql(body, *ctes)``
prepends the named CTEs and everything they depend on, in order.
"""

from __future__ import annotations

from cartlens.schema import CARD_STATUSES, ITEM_STATUSES, WS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def clean(x: str, case: str | None = None) -> str:
    s = f"NULLIF({strip(x)}, '')"
    return {"lower": f"lower({s})", "upper": f"upper({s})"}.get(case, s)


def money_sum(x: str) -> str:
    return f"coalesce(sum(CASE WHEN isnan({x}) THEN NULL ELSE {x} END), CAST(0 AS DOUBLE))"


def sex(x: str) -> str:
    u = clean(x, "upper")
    return (f"CASE WHEN {u} IN ('M', 'MASCHIO', 'UOMO') THEN 'M' "
            f"WHEN {u} IN ('F', 'FEMMINA', 'DONNA') THEN 'F' ELSE NULL END")


def days_after(day: str, n: str) -> str:
    return f"CAST(DATE '{day}' + CAST({n} AS INTEGER) AS TIMESTAMP)"


CTES: dict[str, tuple[str, list[str]]] = {}


def _cte(name: str, body: str, deps: list[str] | None = None) -> None:
    CTES[name] = (body, deps or [])


_cte("raw_users", f"""
SELECT c.c_custkey AS user_uid,
       {days_after('2018-01-01', 'c.c_custkey % 1461')} AS created_at,
       c.c_mktsegment AS source,
       CASE WHEN c.c_custkey % 37 = 5 THEN '   '
            WHEN c.c_custkey % 4 = 0 THEN ' ' || n.n_name || '  '
            WHEN c.c_custkey % 4 = 1 THEN lower(n.n_name)
            WHEN c.c_custkey % 4 = 2 THEN upper(n.n_name)
            ELSE n.n_name END AS city,
       'l' || CAST(c.c_custkey % 13 AS VARCHAR) AS language,
       CASE WHEN c.c_custkey % 5 = 0 THEN NULL
            WHEN c.c_custkey % 5 = 1 THEN '[]'
            WHEN c.c_custkey % 5 = 2 THEN ' '
            ELSE '[z' || CAST(c.c_custkey % 3 AS VARCHAR) || ',z' || CAST(c.c_custkey % 7 AS VARCHAR) || ',]'
       END AS favourite_zones
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

_cte("users", f"""
SELECT user_uid, created_at, source, {clean('city', 'lower')} AS city, language
FROM raw_users""", ["raw_users"])

_cte("raw_profiles", f"""
SELECT c.c_custkey AS profile_uid,
       CASE WHEN c.c_custkey % 11 = 3 THEN c.c_custkey + 100000000
            WHEN c.c_custkey % 11 = 5 THEN NULL
            ELSE c.c_custkey - c.c_custkey % 2 END AS user_uid,
       {days_after('1950-01-01', '(c.c_custkey * 37) % 20000')} AS birthday,
       CASE c.c_custkey % 6 WHEN 0 THEN ' maschio' WHEN 1 THEN 'F' WHEN 2 THEN 'Donna'
            WHEN 3 THEN 'x' WHEN 4 THEN NULL ELSE 'uomo ' END AS sex,
       CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE ' ' || n.n_name END AS city,
       CASE c.c_custkey % 4 WHEN 0 THEN 'beginner' WHEN 1 THEN 'intermediate'
            WHEN 2 THEN 'expert' ELSE NULL END AS level
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")

_cte("profiles", f"""
SELECT profile_uid, user_uid, birthday, {sex('sex')} AS sex, {clean('city', 'lower')} AS city, level
FROM raw_profiles
WHERE user_uid IS NULL OR user_uid IN (SELECT user_uid FROM users)""", ["raw_profiles", "users"])

_cte("raw_orders", """
SELECT o_orderkey AS order_uid,
       CASE WHEN o_orderkey % 101 = 7 THEN o_custkey + 100000000
            WHEN o_orderkey % 103 = 11 THEN NULL ELSE o_custkey END AS user_uid,
       o_orderdate AS created_at,
       CASE WHEN o_orderkey % 2 = 0 THEN lower(o_orderpriority) ELSE ' ' || o_orderpriority END AS source,
       o_orderstatus AS tenant
FROM orders""")

_cte("shop_orders", f"""
SELECT order_uid, user_uid, created_at, {clean('source', 'lower')} AS source, tenant
FROM raw_orders
WHERE user_uid IN (SELECT user_uid FROM users)""", ["raw_orders", "users"])

_cte("raw_details", """
SELECT CASE WHEN l_orderkey % 89 = 13 THEN l_orderkey + 100000000 ELSE l_orderkey END AS order_uid,
       l_linenumber AS item_uid,
       CASE WHEN l_returnflag = 'R' THEN (CASE WHEN l_linenumber % 2 = 0 THEN 'Fulfilled ' ELSE 'fulfilled' END)
            WHEN l_returnflag = 'N' THEN 'processing'
            WHEN l_linenumber = 3 THEN 'lost'
            ELSE 'cancelled' END AS item_status,
       l_shipdate AS item_date,
       l_partkey AS product_uid,
       CASE WHEN l_orderkey % 97 = 5 THEN -l_extendedprice
            WHEN l_orderkey % 97 = 6 THEN NULL ELSE l_extendedprice END AS item_amount
FROM lineitem""")

_cte("details", f"""
SELECT order_uid, item_uid, item_status, item_date, product_uid, item_amount
FROM (SELECT order_uid, item_uid, {clean('item_status', 'lower')} AS item_status, item_date,
             product_uid, item_amount FROM raw_details)
WHERE item_status IN {in_list(ITEM_STATUSES)}
  AND order_uid IN (SELECT order_uid FROM shop_orders)
  AND item_amount >= 0""", ["raw_details", "shop_orders"])

_cte("products", "SELECT p_partkey AS product_uid, lower(p_type) AS product_type FROM part")

_cte("raw_cards", f"""
SELECT CASE WHEN event_id % 53 = 0 THEN NULL ELSE user_id END AS card_uid,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS assigned_at,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE {days_after('1980-01-01', '(user_id * 11) % 9000')} END AS birthday,
       CASE event_type WHEN 'signup' THEN 'not-assigned' WHEN 'view' THEN ' Valid'
            WHEN 'click' THEN 'pending' WHEN 'error' THEN 'ERROR' ELSE 'purchased' END AS status,
       CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN user_id + 100000000
            ELSE user_id END AS user_uid,
       event_id
FROM events""")

_cte("cards_status", f"""
SELECT card_uid, assigned_at, birthday, {clean('status', 'lower')} AS status, user_uid, event_id
FROM raw_cards""", ["raw_cards"])

_cte("cards_latest", """
SELECT card_uid, assigned_at, birthday, status, user_uid, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY card_uid
                               ORDER BY assigned_at DESC NULLS FIRST, event_id DESC) AS rn
  FROM cards_status WHERE card_uid IS NOT NULL) t
WHERE rn = 1""", ["cards_status"])

EMPTY_CARD = ("coalesce(status = 'not-assigned', false) AND "
              "(user_uid IS NULL OR coalesce(CAST(user_uid AS VARCHAR) = '', false)) AND "
              "assigned_at IS NULL AND birthday IS NULL")

_cte("cards_fk", """
SELECT * FROM cards_latest
WHERE coalesce(status = 'not-assigned', false)
   OR coalesce(user_uid IN (SELECT user_uid FROM users), false)""", ["cards_latest", "users"])

_cte("cards", f"SELECT * FROM cards_fk WHERE NOT ({EMPTY_CARD})", ["cards_fk"])

_cte("raw_reviews", """
SELECT doc_id AS review_uid, CASE WHEN doc_id % 10 = 9 THEN NULL ELSE doc_id * 3 END AS user_uid, text
FROM documents""")

_cte("raw_labelled", """
SELECT d.doc_id AS labelled_review_uid, d.text,
       CASE WHEN l.toxic = 1 THEN ' Negative' WHEN l.quality = 1 THEN 'positive ' ELSE 'NEUTRAL' END
         AS sentiment_label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")

_cte("order_kpi", f"""
SELECT r.order_uid, o.user_uid, o.created_at AS order_date, o.source, o.tenant, r.order_revenue
FROM (SELECT order_uid, {money_sum('item_amount')} AS order_revenue
      FROM details WHERE item_status = 'fulfilled' AND order_uid IS NOT NULL
      GROUP BY order_uid) r
LEFT JOIN shop_orders o ON r.order_uid = o.order_uid""", ["details", "shop_orders"])

_cte("order_rev", f"""
SELECT order_uid, {money_sum('item_amount')} AS amount_paid_eur
FROM details WHERE order_uid IS NOT NULL GROUP BY order_uid""", ["details"])

_cte("customer_orders", """
SELECT o.user_uid, o.order_uid, o.created_at AS order_created_at, o.source AS order_source, o.tenant,
       r.amount_paid_eur, u.created_at AS user_created_at, u.source AS user_source, u.city, u.language
FROM shop_orders o
LEFT JOIN order_rev r ON o.order_uid = r.order_uid
LEFT JOIN users u ON o.user_uid = u.user_uid""", ["shop_orders", "order_rev", "users"])

_cte("rfm_base", f"""
SELECT b.user_uid, b.last_order_date, b.frequency, b.monetary,
       date_sub('day', b.last_order_date, s.snapshot) AS recency
FROM (SELECT user_uid, max(order_date) AS last_order_date, count(order_uid) AS frequency,
             {money_sum('order_revenue')} AS monetary
      FROM order_kpi WHERE user_uid IS NOT NULL GROUP BY user_uid) b,
     (SELECT max(order_date) + INTERVAL 1 DAY AS snapshot FROM order_kpi) s""", ["order_kpi"])

_cte("rfm_breaks", """
SELECT quantile_cont(recency, [0.2, 0.4, 0.6, 0.8]) AS recency_breaks,
       quantile_cont(frequency, [0.2, 0.4, 0.6, 0.8]) AS frequency_breaks,
       quantile_cont(monetary, [0.2, 0.4, 0.6, 0.8]) AS monetary_breaks
FROM rfm_base""", ["rfm_base"])


def _score(x: str, b: str, reverse: bool) -> str:
    s = [5, 4, 3, 2, 1] if reverse else [1, 2, 3, 4, 5]
    arms = " ".join(f"WHEN {x} <= {b}[{i + 1}] THEN {s[i]}" for i in range(4))
    return f"CASE {arms} ELSE {s[4]} END"


_cte("rfm_scores", f"""
SELECT r.*,
       {_score('r.recency', 'k.recency_breaks', True)} AS R_score,
       {_score('r.frequency', 'k.frequency_breaks', False)} AS F_score,
       {_score('r.monetary', 'k.monetary_breaks', False)} AS M_score
FROM rfm_base r, rfm_breaks k""", ["rfm_base", "rfm_breaks"])

_cte("rfm", """
SELECT *, CAST(R_score AS VARCHAR) || CAST(F_score AS VARCHAR) || CAST(M_score AS VARCHAR) AS RFM_score,
       CASE WHEN R_score >= 4 AND F_score >= 4 AND M_score >= 4 THEN 'Champions'
            WHEN R_score >= 3 AND F_score >= 3 THEN 'Loyal'
            WHEN R_score >= 4 AND F_score <= 2 THEN 'New Customers'
            WHEN R_score <= 2 AND F_score >= 3 THEN 'At Risk'
            WHEN R_score <= 2 AND F_score <= 2 AND M_score <= 2 THEN 'Lost'
            ELSE 'Others' END AS segment
FROM rfm_scores""", ["rfm_scores"])

_cte("cut", """
SELECT max(order_date) AS snapshot_date, max(order_date) - INTERVAL 90 DAY AS cutoff_date
FROM order_kpi""", ["order_kpi"])

_cte("churn_labels", """
SELECT l.user_uid, l.last_order_date,
       CAST(coalesce(l.last_order_date < c.cutoff_date, false) AS INTEGER) AS churned
FROM (SELECT user_uid, max(order_date) AS last_order_date FROM order_kpi
      WHERE user_uid IS NOT NULL GROUP BY user_uid) l, cut c""", ["order_kpi", "cut"])

_cte("behavior", f"""
SELECT a.user_uid, a.first_order_date, a.last_order_before_T0, a.freq_total, a.monetary_total,
       date_sub('day', a.first_order_date, c.cutoff_date) AS tenure_days,
       a.monetary_total / a.freq_total AS avg_order_value,
       a.orders_last_30d
FROM (SELECT k.user_uid, min(k.order_date) AS first_order_date, max(k.order_date) AS last_order_before_T0,
             count(k.order_uid) AS freq_total, {money_sum('k.order_revenue')} AS monetary_total,
             count(*) FILTER (WHERE k.order_date >= c.cutoff_date - INTERVAL 30 DAY) AS orders_last_30d
      FROM order_kpi k, cut c
      WHERE k.order_date < c.cutoff_date AND k.user_uid IS NOT NULL
      GROUP BY k.user_uid) a, cut c""", ["order_kpi", "cut"])

_cte("user_profile", """
SELECT user_uid,
       arg_min(city, profile_uid) FILTER (WHERE city IS NOT NULL) AS main_city,
       arg_min(sex, profile_uid) FILTER (WHERE sex IS NOT NULL) AS sex,
       arg_min(level, profile_uid) FILTER (WHERE level IS NOT NULL) AS level
FROM profiles WHERE user_uid IS NOT NULL GROUP BY user_uid""", ["profiles"])

_cte("churn_features", """
SELECT b.*, l.churned, u.created_at, u.source, u.city, u.language, p.main_city, p.sex, p.level
FROM behavior b
JOIN churn_labels l ON b.user_uid = l.user_uid
LEFT JOIN users u ON b.user_uid = u.user_uid
LEFT JOIN user_profile p ON b.user_uid = p.user_uid""", ["behavior", "churn_labels", "users", "user_profile"])


def sql(body: str, *names: str) -> str:
    """``WITH`` the named CTEs (plus dependencies, in dependency order) ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({CTES[n][0].strip()})" for n in order)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"


__all__ = ["sql", "q", "in_list", "strip", "clean", "money_sum", "sex", "CTES",
           "CARD_STATUSES", "ITEM_STATUSES", "EMPTY_CARD"]
