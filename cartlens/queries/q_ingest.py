"""Registered queries for scans, typed parsing and table profiles (A)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from cartlens.catalog import register
from cartlens.functions import parse as ps
from cartlens.oracles.views import in_list, sql
from cartlens.operators import quality as dq
from cartlens.operators.campaign import export_csv
from cartlens.plans.etl import read_clean_tables, shop_clean, shop_raw, write_clean_tables
from cartlens.schema import FALSE_TOKENS, NA_TOKENS, TRUE_TOKENS
from cartlens.session import checkpoint_dir
from cartlens.sources import shop_tables as st
from cartlens.sources.csv_ingest import first_forms, read_raw_csv, read_typed_csv, source_headers, write_csv

_TOKENS_CTE = "raw_tokens"


def _tokens_sql() -> str:
    na = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS + ["NA"])
    bools = ", ".join(f"'{t}'" for t in ["True", "TRUE", "true", "1", "1.0",
                                          "False", "FALSE", "false", "0", "0.0"])
    return f"""
WITH raw_tokens AS (
SELECT event_id,
       CASE WHEN event_id % 3 = 0 THEN ([{na}])[CAST(event_id % {len(NA_TOKENS) + 1} AS INTEGER) + 1]
            ELSE event_type END AS raw_text,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE ([{bools}])[CAST(event_id % 10 AS INTEGER) + 1] END AS raw_bool,
       CASE WHEN event_id % 19 = 0 THEN NULL
            ELSE CAST(user_id % 50 AS VARCHAR) || CASE WHEN event_id % 2 = 0 THEN '.0' ELSE '' END END AS raw_int,
       CASE WHEN event_id % 23 = 0 THEN NULL ELSE printf('%.2f', value) END AS raw_double,
       CASE WHEN event_id % 7 = 0 THEN 'not a date'
            WHEN event_id % 7 = 1 THEN strftime(ts, '%Y-%m-%d')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw_ts
FROM events)"""


def _with_tokens(body: str) -> str:
    return _tokens_sql().strip() + "\n" + body.strip()


@register("na_tokens", _with_tokens(f"""
SELECT event_id, raw_text, CASE WHEN raw_text IN {in_list(NA_TOKENS)} THEN NULL ELSE raw_text END AS value
FROM raw_tokens"""))
def q_na_tokens(spark, sf):
    t = st.raw_tokens(spark, sf)
    return t.select("event_id", "raw_text", ps.na_to_null("raw_text").alias("value"))


@register("parse_boolean", _with_tokens(f"""
SELECT event_id, raw_bool, CASE WHEN raw_bool IN {in_list(TRUE_TOKENS)} THEN true
                                WHEN raw_bool IN {in_list(FALSE_TOKENS)} THEN false END AS value
FROM raw_tokens"""))
def q_parse_boolean(spark, sf):
    t = st.raw_tokens(spark, sf)
    return t.select("event_id", "raw_bool", ps.parse_boolean("raw_bool", "raw_bool").alias("value"))


@register("parse_integer", _with_tokens("""
SELECT event_id, raw_int, CAST(CAST(raw_int AS DOUBLE) AS BIGINT) AS value FROM raw_tokens"""))
def q_parse_integer(spark, sf):
    t = st.raw_tokens(spark, sf)
    return t.select("event_id", "raw_int", ps.parse_integer("raw_int", "raw_int").alias("value"))


@register("parse_double", _with_tokens("""
SELECT event_id, raw_double, CAST(raw_double AS DOUBLE) AS value FROM raw_tokens"""))
def q_parse_double(spark, sf):
    t = st.raw_tokens(spark, sf)
    return t.select("event_id", "raw_double", ps.parse_double("raw_double", "raw_double").alias("value"))


@register("parse_ts_coerce", _with_tokens("""
SELECT event_id, raw_ts, TRY_CAST(raw_ts AS TIMESTAMP) AS value FROM raw_tokens"""))
def q_parse_ts_coerce(spark, sf):
    t = st.raw_tokens(spark, sf)
    return t.select("event_id", "raw_ts", ps.parse_ts_coerce("raw_ts").alias("value"))


@register("distinct_values", sql("""
SELECT status, count(*) AS num_rows FROM raw_cards GROUP BY status""", "raw_cards"))
def q_distinct_values(spark, sf):
    return dq.distinct_values(st.raw_cards(spark, sf), "status")


_PROFILED = ["users", "profiles", "cards", "orders", "order_details", "reviews", "reviews_labelled"]
_PROFILE_CTE = {"users": "raw_users", "profiles": "raw_profiles", "cards": "raw_cards",
                "orders": "raw_orders", "order_details": "raw_details", "reviews": "raw_reviews",
                "reviews_labelled": "raw_labelled"}


# Declared column counts of the raw entities (see sources.shop_tables).
_RAW_WIDTH = {"users": 6, "profiles": 6, "cards": 6, "orders": 5, "order_details": 6,
              "reviews": 3, "reviews_labelled": 3}


def _profile_sql() -> str:
    parts = [f"SELECT '{n}' AS table_name, count(*) AS num_rows, "
             f"CAST({_RAW_WIDTH[n]} AS INTEGER) AS num_columns FROM {_PROFILE_CTE[n]}" for n in _PROFILED]
    return sql("\nUNION ALL\n".join(parts), *_PROFILE_CTE.values())


@register("table_profile", _profile_sql())
def q_table_profile(spark, sf):
    raw = shop_raw(spark, sf)
    return reduce(lambda a, b: a.unionByName(b), [dq.table_profile(raw[n], n) for n in _PROFILED])



_PREVIEWED = {"users": ("raw_users", ["user_uid", "source", "language"], ["user_uid"]),
              "orders": ("raw_orders", ["order_uid", "user_uid", "source", "tenant"], ["order_uid"]),
              "cards": ("raw_cards", ["card_uid", "status", "event_id"], ["card_uid", "event_id"])}


def _preview_sql() -> str:
    parts = []
    for n, (cte, columns, order) in _PREVIEWED.items():
        by = ", ".join(f"{c} ASC NULLS LAST" for c in order)
        text = " || ' | ' || ".join(f"coalesce(CAST({c} AS VARCHAR), '<missing>')" for c in columns)
        parts.append(f"""SELECT '{n}' AS table_name, CAST(row_number() OVER (ORDER BY {by}) AS INTEGER) AS row_no,
  '{", ".join(columns)}' AS columns, {text} AS row_text FROM {cte} QUALIFY row_number() OVER (ORDER BY {by}) <= 5""")
    return sql("\nUNION ALL\n".join(parts), "raw_users", "raw_orders", "raw_cards")


@register("table_preview", _preview_sql())
def q_table_preview(spark, sf):
    """The first rows of three raw tables by their key, and their columns (of the chosen ones)."""
    raw = shop_raw(spark, sf)
    return reduce(lambda a, b: a.unionByName(b), [dq.preview(raw[n].select(*columns), n, order)
                                                  for n, (_, columns, order) in _PREVIEWED.items()])


_MIXED = """
WITH mixed AS (
SELECT event_id,
       CASE WHEN event_id % 11 = 0 THEN 'NULL' WHEN event_id % 5 = 1 THEN strftime(ts, '%Y-%m-%d')
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS a,
       CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 4 = 3 THEN strftime(ts, '%d/%m/%Y %H:%M')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS b
FROM events),
firsts AS (SELECT arg_min(a, event_id) FILTER (WHERE a <> 'NULL') AS fa, arg_min(b, event_id) FILTER (WHERE b <> '') AS fb FROM mixed)"""


def _form_sql(value: str, first: str) -> str:
    return f"""CASE WHEN length({value}) = length({first}) AND contains({value}, 'T') = contains({first}, 'T') AND contains({value}, '/') = contains({first}, '/')
  THEN CASE WHEN contains({value}, '/') AND substr({first}, 1, 2) > '12' THEN try_strptime({value}, '%d/%m/%Y %H:%M')
       WHEN contains({value}, '/') THEN try_strptime({value}, '%m/%d/%Y %H:%M') ELSE TRY_CAST({value} AS TIMESTAMP) END END"""


@register("parse_ts_one_form", f"{_MIXED} SELECT event_id, {_form_sql('a', 'fa')} AS a, {_form_sql('b', 'fb')} AS b FROM mixed, firsts")
def q_parse_ts_one_form(spark, sf):
    """Columns with several forms; only values in the form of the column's first value (by event) are read."""
    i = F.col("event_id")
    mixed = st.table(spark, sf, "events").select(
        "event_id",
        F.when(i % 11 == 0, "NULL").when(i % 5 == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("a"),
        F.when(i % 13 == 0, "").when(i % 4 == 3, F.date_format("ts", "dd/MM/yyyy HH:mm")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("b"))
    forms = first_forms(mixed, ["a", "b"], i)
    return mixed.select("event_id", *[ps.parse_ts_coerce(ps.na_to_null(c), forms[c]).alias(c) for c in ("a", "b")])


@register("parse_ts_strict", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS raw_ts, CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS value
FROM events""")
def q_parse_ts_strict(spark, sf):
    """The strict parser reads a column of one format."""
    e = st.table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("raw_ts"))
    return e.select("event_id", "raw_ts", ps.parse_ts_strict("raw_ts", name="raw_ts").alias("value"))


def _scratch(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("parquet_round_trip", sql("""
SELECT 'users' AS table_name, CAST(user_uid AS VARCHAR) AS key, CAST(created_at AS VARCHAR) AS detail FROM users
UNION ALL SELECT 'orders', CAST(order_uid AS VARCHAR), source FROM shop_orders
UNION ALL SELECT 'order_details', CAST(order_uid AS VARCHAR) || ':' || CAST(item_uid AS VARCHAR), item_status FROM details""",
                                    "users", "shop_orders", "details"))
def q_parquet_round_trip(spark, sf):
    """Clean tables written as Parquet and read back."""
    names = ["users", "orders", "order_details"]
    clean, path = shop_clean(spark, sf), _scratch(spark, "clean")
    write_clean_tables({n: clean[n] for n in names}, path)
    t = read_clean_tables(spark, path, names)
    row = [t["users"].select(F.lit("users").alias("table_name"), F.col("user_uid").cast("string").alias("key"),
                             F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("detail")),
           t["orders"].select(F.lit("orders"), F.col("order_uid").cast("string"), "source"),
           t["order_details"].select(F.lit("order_details"), F.concat_ws(":", "order_uid", "item_uid"), "item_status")]
    return reduce(lambda a, b: a.union(b), row)


@register("csv_round_trip", """
SELECT CAST(c_custkey AS VARCHAR) AS user_uid, c_mktsegment AS source, CAST(round(c_acctbal, 2) AS DOUBLE) AS balance FROM customer""")
def q_csv_round_trip(spark, sf):
    """A10: an export written as CSV with a header and read back by name."""
    path = _scratch(spark, "export")
    c = st.table(spark, sf, "customer")
    export_csv(c.select(F.col("c_custkey").alias("user_uid"), F.col("c_mktsegment").alias("source"),
                        F.round("c_acctbal", 2).alias("balance")), path)
    raw = read_raw_csv(spark, path)
    return raw.select("user_uid", "source", ps.parse_double("balance", "balance").alias("balance"))


@register("csv_line_breaks", sql("""
SELECT CAST(review_uid AS VARCHAR) AS review_uid, CAST(user_uid AS VARCHAR) AS user_uid,
       replace(text, ' ', CASE WHEN review_uid % 3 = 0 THEN chr(10) WHEN review_uid % 3 = 1 THEN ' "' ELSE ',' END) AS text
FROM raw_reviews""", "raw_reviews"))
def q_csv_line_breaks(spark, sf):
    """A1: reviews whose texts hold line breaks, quotes and commas, written as CSV and read by byte ranges."""
    path, i = _scratch(spark, "reviews"), F.col("review_uid")
    broken = F.replace("text", F.lit(" "), F.when(i % 3 == 0, "\n").when(i % 3 == 1, ' "').otherwise(","))
    write_csv(st.raw_reviews(spark, sf).withColumn("text", broken), path, source_headers("reviews"))
    return read_typed_csv(spark, path, "reviews")
