"""Shop entities derived from the supplied parquet tables.

The shop's own CSVs are not available, so each raw entity is a projection of
a supplied table, with deterministic "dirt" (padding, case, NA values, orphan
keys, bad statuses, negative amounts) chosen by key modulus so that every
cleaning, check and repair operator has something to find. The same mapping
is written in SQL in :mod:`cartlens.oracles.views` for the DuckDB oracle.

All work is columnar projections; the only join is customer -> nation, a
fixed 25-row dimension, which is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORPHAN_OFFSET = 100_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one supplied table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _days_after(day: str, n: Column) -> Column:
    return F.date_add(F.lit(day).cast("date"), n.cast("int")).cast("timestamp_ntz")


def _nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation is a fixed 25-row dimension: broadcasting it is size-bounded.
    return F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = c.join(_nation_names(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left")
    k = F.col("c_custkey")
    n = F.col("n_name")
    city = (F.when(k % 37 == 5, F.lit("   "))
            .when(k % 4 == 0, F.concat(F.lit(" "), n, F.lit("  ")))
            .when(k % 4 == 1, F.lower(n))
            .when(k % 4 == 2, F.upper(n))
            .otherwise(n))
    zones = (F.when(k % 5 == 0, F.lit(None).cast("string"))
             .when(k % 5 == 1, F.lit("[]"))
             .when(k % 5 == 2, F.lit(" "))
             .otherwise(F.concat(F.lit("[z"), (k % 3).cast("string"), F.lit(",z"),
                                 (k % 7).cast("string"), F.lit(",]"))))
    return j.select(
        k.alias("user_uid"),
        _days_after("2018-01-01", k % 1461).alias("created_at"),
        F.col("c_mktsegment").alias("source"),
        city.alias("city"),
        F.concat(F.lit("l"), (k % 13).cast("string")).alias("language"),
        zones.alias("favourite_zones"),
    )


def raw_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = c.join(_nation_names(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left")
    k = F.col("c_custkey")
    user = (F.when(k % 11 == 3, k + ORPHAN_OFFSET)
            .when(k % 11 == 5, F.lit(None).cast("long"))
            .otherwise(k - k % 2))
    sex = (F.when(k % 6 == 0, F.lit(" maschio")).when(k % 6 == 1, F.lit("F"))
           .when(k % 6 == 2, F.lit("Donna")).when(k % 6 == 3, F.lit("x"))
           .when(k % 6 == 4, F.lit(None).cast("string")).otherwise(F.lit("uomo ")))
    level = (F.when(k % 4 == 0, F.lit("beginner")).when(k % 4 == 1, F.lit("intermediate"))
             .when(k % 4 == 2, F.lit("expert")).otherwise(F.lit(None).cast("string")))
    city = F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit(" "), F.col("n_name")))
    return j.select(
        k.alias("profile_uid"), user.alias("user_uid"),
        _days_after("1950-01-01", (k * 37) % 20000).alias("birthday"),
        sex.alias("sex"), city.alias("city"), level.alias("level"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    user = (F.when(k % 101 == 7, F.col("o_custkey") + ORPHAN_OFFSET)
            .when(k % 103 == 11, F.lit(None).cast("long"))
            .otherwise(F.col("o_custkey")))
    source = (F.when(k % 2 == 0, F.lower("o_orderpriority"))
              .otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"))))
    return o.select(
        k.alias("order_uid"), user.alias("user_uid"), F.col("o_orderdate").alias("created_at"),
        source.alias("source"), F.col("o_orderstatus").alias("tenant"),
    )


def raw_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    ln = F.col("l_linenumber")
    flag = F.col("l_returnflag")
    status = (F.when(flag == "R", F.when(ln % 2 == 0, F.lit("Fulfilled ")).otherwise(F.lit("fulfilled")))
              .when(flag == "N", F.lit("processing"))
              .when(ln == 3, F.lit("lost"))
              .otherwise(F.lit("cancelled")))
    amount = (F.when(k % 97 == 5, -F.col("l_extendedprice"))
              .when(k % 97 == 6, F.lit(None).cast("double"))
              .otherwise(F.col("l_extendedprice")))
    order = F.when(k % 89 == 13, k + ORPHAN_OFFSET).otherwise(k)
    return li.select(
        order.alias("order_uid"), ln.alias("item_uid"), status.alias("item_status"),
        F.col("l_shipdate").alias("item_date"), F.col("l_partkey").alias("product_uid"),
        amount.alias("item_amount"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_uid"), F.lower("p_type").alias("product_type"))


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    u = F.col("user_id")
    et = F.col("event_type")
    status = (F.when(et == "signup", F.lit("not-assigned")).when(et == "view", F.lit(" Valid"))
              .when(et == "click", F.lit("pending")).when(et == "error", F.lit("ERROR"))
              .otherwise(F.lit("purchased")))
    user = (F.when(k % 7 == 0, F.lit(None).cast("long"))
            .when(k % 5 == 0, u + ORPHAN_OFFSET).otherwise(u))
    return e.select(
        F.when(k % 53 == 0, F.lit(None).cast("long")).otherwise(u).alias("card_uid"),
        F.when(k % 97 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")).alias("assigned_at"),
        F.when(k % 3 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(_days_after("1980-01-01", (u * 11) % 9000)).alias("birthday"),
        status.alias("status"), user.alias("user_uid"), k.alias("event_id"),
    )


def raw_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events.props with one value in eleven truncated into invalid JSON."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    props = F.when(k % 11 == 0, F.expr("substring(props, 2)")).otherwise(F.col("props"))
    return e.select(k.alias("event_id"), props.alias("props"))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    return d.select(k.alias("review_uid"),
                    F.when(k % 10 == 9, F.lit(None).cast("long")).otherwise(k * 3).alias("user_uid"),
                    F.col("text"))


def raw_reviews_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id")
    label = (F.when(F.col("toxic") == 1, F.lit(" Negative"))
             .when(F.col("quality") == 1, F.lit("positive "))
             .otherwise(F.lit("NEUTRAL")))
    return j.select(F.col("doc_id").alias("labelled_review_uid"), "text", label.alias("sentiment_label"))


def raw_pages_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as review-like text: html, a space, then the url."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.concat_ws(" ", "html", "url").alias("text"))


def raw_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String columns for the typed parsers, derived from events."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    from cartlens.schema import NA_TOKENS
    na_pick = F.element_at(F.array(*[F.lit(t) for t in NA_TOKENS + ["NA"]]),
                           (k % (len(NA_TOKENS) + 1) + 1).cast("int"))
    value_txt = F.format_string("%.2f", F.col("value"))
    bools = F.element_at(F.array(*[F.lit(t) for t in ["True", "TRUE", "true", "1", "1.0",
                                                       "False", "FALSE", "false", "0", "0.0"]]),
                         (k % 10 + 1).cast("int"))
    return e.select(
        k.alias("event_id"),
        F.when(k % 3 == 0, na_pick).otherwise(F.col("event_type")).alias("raw_text"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(bools).alias("raw_bool"),
        F.when(k % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat((F.col("user_id") % 50).cast("string"),
                             F.when(k % 2 == 0, F.lit(".0")).otherwise(F.lit("")))).alias("raw_int"),
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(value_txt).alias("raw_double"),
        F.when(k % 7 == 0, F.lit("not a date"))
         .when(k % 7 == 1, F.date_format("ts", "yyyy-MM-dd"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("raw_ts"),
    )
