"""Registered queries for column cleaning (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartlens.catalog import register
from cartlens.functions import text as tx
from cartlens.oracles.views import WS, clean, q, sex, sql, strip
from cartlens.operators import quality as dq
from cartlens.operators import repair
from cartlens.plans.etl import clean_reviews_labelled
from cartlens.schema import MIN_REVIEW_LENGTH, REVIEW_KEEP_CLASS, WS_CLASS
from cartlens.sources import shop_tables as st


def sql_review_clean(x: str) -> str:
    """B7 in DuckDB SQL (RE2 has no back-references: one collapse per mark)."""
    t = f"lower(coalesce({x}, ''))"
    t = f"regexp_replace({t}, {q('http[^' + WS_CLASS + ']+|www[^' + WS_CLASS + ']+')}, '', 'g')"
    t = f"regexp_replace({t}, '<.*?>', '', 'g')"
    t = f"regexp_replace({t}, {q('[^' + REVIEW_KEEP_CLASS + WS_CLASS + ']')}, ' ', 'g')"
    t = strip(f"regexp_replace({t}, {q(WS + '+')}, ' ', 'g')")
    for mark in ("!", r"\?", r"\.", ","):
        t = f"regexp_replace({t}, {q(mark + '{2,}')}, {q(mark.lstrip(chr(92)))}, 'g')"
    return t


def sql_normalize_ws(x: str) -> str:
    return strip(f"regexp_replace({x}, {q(WS + '+')}, ' ', 'g')")


@register("clean_text_lower", sql(f"""
SELECT user_uid, city AS city_raw, {clean('city', 'lower')} AS city FROM raw_users""", "raw_users"))
def q_clean_text_lower(spark, sf):
    u = st.raw_users(spark, sf)
    return u.select("user_uid", F.col("city").alias("city_raw"), tx.clean_str("city", "lower").alias("city"))


@register("clean_text_upper", sql(f"""
SELECT profile_uid, sex AS sex_raw, {clean('sex', 'upper')} AS sex_upper, {clean('city')} AS city
FROM raw_profiles""", "raw_profiles"))
def q_clean_text_upper(spark, sf):
    p = st.raw_profiles(spark, sf)
    return p.select("profile_uid", F.col("sex").alias("sex_raw"),
                    tx.clean_str("sex", "upper").alias("sex_upper"), tx.clean_str("city").alias("city"))


_LIST_BODY = (r"regexp_replace(regexp_replace(s, '^\[', ''), '\]$', '')")


@register("parse_list_string", sql(f"""
SELECT user_uid, favourite_zones AS zones_raw,
       CASE WHEN s IS NULL THEN 0 ELSE len(string_split({_LIST_BODY}, ',')) END AS num_zones,
       CASE WHEN s IS NULL THEN '' ELSE array_to_string(string_split({_LIST_BODY}, ','), '|') END AS zones
FROM (SELECT user_uid, favourite_zones, {clean('favourite_zones')} AS s FROM raw_users)""", "raw_users"))
def q_parse_list_string(spark, sf):
    u = st.raw_users(spark, sf)
    arr = tx.parse_list_string("favourite_zones")
    return u.select("user_uid", F.col("favourite_zones").alias("zones_raw"),
                    F.size(arr).alias("num_zones"), F.array_join(arr, "|").alias("zones"))


@register("json_validity", """
SELECT count(*) FILTER (WHERE props IS NOT NULL AND NOT json_valid(props)) AS props_invalid
FROM (SELECT CASE WHEN event_id % 11 = 0 THEN substr(props, 2) ELSE props END AS props FROM events)""")
def q_json_validity(spark, sf):
    return dq.json_validity(st.raw_events_json(spark, sf), ["props"])


@register("canonical_sex", sql(f"""
SELECT profile_uid, sex AS sex_raw, {sex('sex')} AS sex FROM raw_profiles""", "raw_profiles"))
def q_canonical_sex(spark, sf):
    p = st.raw_profiles(spark, sf)
    return p.select("profile_uid", F.col("sex").alias("sex_raw"), tx.canonical_sex("sex").alias("sex"))


@register("normalize_whitespace", sql(f"""
SELECT review_uid, user_uid, {sql_normalize_ws('text')} AS text FROM raw_reviews""", "raw_reviews"))
def q_normalize_whitespace(spark, sf):
    r = st.raw_reviews(spark, sf)
    return r.select("review_uid", "user_uid", tx.normalize_whitespace("text").alias("text"))


@register("normalize_label", sql(f"""
SELECT labelled_review_uid, sentiment_label AS label_raw, lower({strip('sentiment_label')}) AS sentiment_label
FROM raw_labelled""", "raw_labelled"))
def q_normalize_label(spark, sf):
    r = st.raw_reviews_labelled(spark, sf)
    return r.select("labelled_review_uid", F.col("sentiment_label").alias("label_raw"),
                    tx.normalize_label("sentiment_label").alias("sentiment_label"))


@register("clean_review_text", sql(f"""
SELECT review_uid, {sql_review_clean(sql_normalize_ws('text'))} AS text FROM raw_reviews""", "raw_reviews"))
def q_clean_review_text(spark, sf):
    r = st.raw_reviews(spark, sf)
    return r.select("review_uid", tx.clean_review_text(tx.normalize_whitespace("text")).alias("text"))


@register("clean_review_text_pages", f"""
SELECT page_id, {sql_review_clean("concat_ws(' ', html, url)")} AS text FROM pages""")
def q_clean_review_text_pages(spark, sf):
    p = st.raw_pages_text(spark, sf)
    return p.select("page_id", tx.clean_review_text("text").alias("text"))


@register("min_length_filter", sql(f"""
SELECT labelled_review_uid, text, sentiment_label FROM (
  SELECT labelled_review_uid, {sql_review_clean(sql_normalize_ws('text'))} AS text,
         lower({strip('sentiment_label')}) AS sentiment_label FROM raw_labelled)
WHERE length(text) > {MIN_REVIEW_LENGTH}""", "raw_labelled"))
def q_min_length_filter(spark, sf):
    r = clean_reviews_labelled(st.raw_reviews_labelled(spark, sf))
    r = r.withColumn("text", tx.clean_review_text("text"))
    return repair.keep_where(r, "text", lambda t: tx.text_length(t) > MIN_REVIEW_LENGTH)
