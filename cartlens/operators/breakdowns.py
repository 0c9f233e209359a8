"""Revenue and customer breakdowns (F1-F16).

Top-k reports sort by value descending with the group key as tie-break, so
the k rows are well defined; ``orderBy(...).limit(k)`` plans as
TakeOrderedAndProject (per-partition top-k, then a k-row merge).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.operators.stats import money_sum, with_scalars
from cartlens.schema import AGE_BINS, DENSITY_GRID, ORDER_DATE_CANDIDATES, SOURCE_KEYWORDS


def top_k(df: DataFrame, value: str, key: str, k: int | None = 10) -> DataFrame:
    ordered = df.orderBy(F.col(value).desc(), F.col(key).asc())
    return ordered if k is None else ordered.limit(k)


def revenue_by_city(co: DataFrame, k: int | None = 10) -> DataFrame:
    """revenue per city (null city or revenue dropped), top k."""
    agg = (co.where(F.col("city").isNotNull() & F.col("amount_paid_eur").isNotNull())
           .groupBy("city").agg(money_sum("amount_paid_eur").alias("revenue")))
    return top_k(agg, "revenue", "city", k)


def customers_by_city(co: DataFrame, k: int | None = 10) -> DataFrame:
    """distinct customers (with an order) per city, top k."""
    agg = (co.where(F.col("city").isNotNull()).groupBy("city")
           .agg(F.count_distinct("user_uid").alias("unique_customers")))
    return top_k(agg, "unique_customers", "city", k)


def orders_per_customer_city(co: DataFrame, min_customers: int = 50,
                             k: int | None = 10) -> DataFrame:
    """orders, distinct customers and their ratio per city; cities with
    more than ``min_customers`` customers; top k by ratio."""
    agg = (co.where(F.col("city").isNotNull()).groupBy("city")
           .agg(F.count("order_uid").alias("total_orders"),
                F.count_distinct("user_uid").alias("unique_customers"))
           .where(F.col("unique_customers") > min_customers)
           .withColumn("orders_per_customer", F.col("total_orders") / F.col("unique_customers")))
    return top_k(agg, "orders_per_customer", "city", k)


def orders_per_customer(co: DataFrame) -> DataFrame:
    """orders per customer (null user dropped)."""
    return (co.where(F.col("user_uid").isNotNull()).groupBy("user_uid")
            .agg(F.count(F.lit(1)).alias("num_orders")))


def one_time_vs_repeat(per_customer: DataFrame) -> DataFrame:
    """one-time and repeat customers, totals and shares (one row)."""
    n = F.col("num_orders")
    return (per_customer.agg(F.count(F.lit(1)).alias("total_customers"),
                             F.count_if(n == 1).alias("one_time_buyers"),
                             F.count_if(n > 1).alias("repeat_customers"))
            .withColumn("one_time_share", F.col("one_time_buyers") / F.col("total_customers"))
            .withColumn("repeat_share", F.col("repeat_customers") / F.col("total_customers")))


def age_years(birthday: Column, as_of: Column) -> Column:
    """whole days from birthday to ``as_of``, floor-divided by 365."""
    return F.floor(F.timestamp_diff("DAY", birthday, as_of) / 365).cast("long")


def with_age(profiles: DataFrame, as_of: str | None = None) -> DataFrame:
    now = F.lit(as_of).cast("timestamp_ntz") if as_of else F.current_timestamp().cast("timestamp_ntz")
    return profiles.withColumn("age", age_years(F.col("birthday"), now))


def age_stats(aged: DataFrame) -> DataFrame:
    """mean and median age (one row)."""
    return aged.agg(F.avg("age").alias("mean_age"), F.median("age").alias("median_age"))


def age_modes(aged: DataFrame) -> DataFrame:
    """every most frequent age (ties kept)."""
    counts = aged.where(F.col("age").isNotNull()).groupBy("age").agg(F.count(F.lit(1)).alias("num_profiles"))
    top = counts.agg(F.max("num_profiles").alias("_max"))
    return (with_scalars(counts, top).where(F.col("num_profiles") == F.col("_max")).drop("_max"))


def age_histogram(aged: DataFrame, bins: int = AGE_BINS) -> DataFrame:
    """F8: ``bins`` equal-width bins from min to max age, last bin closed,
    empty bins included. Edge k is min + k * (max - min) / bins; a value goes
    to the bin whose edges enclose it (boundary values go right)."""
    ages = aged.where(F.col("age").isNotNull()).select(F.col("age").cast("double").alias("x"))
    rng = ages.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))

    def edge(i: Column) -> Column:
        return F.col("lo") + i * step

    raw = F.least(F.floor((F.col("x") - F.col("lo")) * F.lit(float(bins)) / (F.col("hi") - F.col("lo"))),
                  F.lit(bins - 1))
    raw = F.coalesce(raw, F.lit(0))
    fixed = (F.when(F.col("x") < edge(F.col("_b")), F.col("_b") - 1)
             .when((F.col("x") >= edge(F.col("_b") + 1)) & (F.col("_b") < bins - 1), F.col("_b") + 1)
             .otherwise(F.col("_b")))
    tagged = (with_scalars(ages, rng).withColumn("_b", raw.cast("long"))
              .withColumn("bin", fixed).groupBy("bin").agg(F.count(F.lit(1)).alias("num_profiles")))
    grid = (rng.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
            .withColumn("bin", F.col("bin").cast("long")))
    return (grid.join(tagged, "bin", "left")
            .select("bin", F.round(edge(F.col("bin")), 6).alias("bin_start"),
                    F.round(edge(F.col("bin") + 1), 6).alias("bin_end"),
                    F.coalesce(F.col("num_profiles"), F.lit(0)).alias("num_profiles")))


def age_density(aged: DataFrame, grid_points: int = DENSITY_GRID) -> DataFrame:
    """Gaussian kernel density of age on ``grid_points`` points from min
    to max, Scott bandwidth n^(-1/5) * sample std.

    Ages are first reduced to (age, count): the number of distinct ages is
    bounded (years of a human life), so the grid x distinct-ages product that
    follows is bounded too, whatever the number of profiles.
    """
    counts = (aged.where(F.col("age").isNotNull()).groupBy("age")
              .agg(F.count(F.lit(1)).alias("c")).select(F.col("age").cast("double").alias("a"), "c"))
    stats = aged.where(F.col("age").isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp(F.col("age").cast("double")).alias("sd"),
        F.min(F.col("age").cast("double")).alias("lo"), F.max(F.col("age").cast("double")).alias("hi"))
    stats = stats.withColumn("h", F.col("sd") * F.pow(F.col("n"), F.lit(-0.2)))
    g = F.lit(float(grid_points - 1))
    grid = stats.select(F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("grid_index"),
                        "lo", "hi", "n", "h")
    grid = grid.withColumn("x", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("grid_index") / g)
    z = (F.col("x") - F.col("a")) / F.col("h")
    term = F.col("c") * F.exp(F.lit(-0.5) * z * z)
    dens = (grid.crossJoin(F.broadcast(counts))
            .groupBy("grid_index", "x", "n", "h")
            .agg(F.sum(term).alias("_s")))
    return dens.select(
        F.col("grid_index").cast("int").alias("grid_index"), F.round("x", 6).alias("age"),
        F.round(F.col("_s") / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))), 9).alias("density"))


def share_pct(df: DataFrame, column: str, name: str = "share_pct") -> DataFrame:
    """Percentage of each non-null value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_c"))
    total = counts.agg(F.sum("_c").alias("_t"))
    return (with_scalars(counts, total)
            .select(column, F.round(F.col("_c") * 100.0 / F.col("_t"), 6).alias(name)))


def revenue_by_product_type(details_typed: DataFrame, status: str | None = "fulfilled",
                            k: int | None = None) -> DataFrame:
    """revenue per product type over fulfilled items; full list or top k."""
    src = details_typed if status is None else details_typed.where(F.col("item_status") == status)
    agg = (src.where(F.col("product_type").isNotNull()).groupBy("product_type")
           .agg(money_sum("item_amount").alias("revenue")))
    return top_k(agg, "revenue", "product_type", k)


def find_source_column(columns: list[str], keywords: list[str] = SOURCE_KEYWORDS) -> str | None:
    """first column whose lower-case name contains a keyword (schema only)."""
    for c in columns:
        if any(k in c.lower() for k in keywords):
            return c
    return None


def revenue_by_source(co: DataFrame, source: str | None = None) -> DataFrame:
    """revenue per source value; an all-null group sums to 0."""
    col = source or find_source_column(co.columns)
    if col is None:
        raise ValueError("no source-like column")
    return (co.where(F.col(col).isNotNull()).groupBy(col)
            .agg(money_sum("amount_paid_eur").alias("revenue")))


def find_date_column(columns: list[str], candidates: list[str] = ORDER_DATE_CANDIDATES) -> str | None:
    for c in candidates:
        if c in columns:
            return c
    return None


def order_volume(orders: DataFrame, date: str | None = None, period: str = "month") -> DataFrame:
    """orders per calendar period between the first and last order;
    empty periods appear with 0. Month labels are month ends, week labels the
    week's Sunday, day labels the day.

    The period grid is a ``sequence`` over one (min, max) row: its size is the
    number of periods spanned, independent of the number of orders.
    """
    col = date or find_date_column(orders.columns)
    ts = F.col(col).cast("timestamp_ntz")
    if period == "month":
        label = F.last_day(ts)
        step = F.expr("INTERVAL 1 MONTH")
    elif period == "week":
        label = F.date_add(F.date_trunc("week", ts).cast("date"), 6)
        step = F.expr("INTERVAL 7 DAYS")
    elif period == "day":
        label = ts.cast("date")
        step = F.expr("INTERVAL 1 DAY")
    else:
        raise ValueError("period must be month, week or day")
    counts = (orders.where(ts.isNotNull()).groupBy(label.alias("_p"))
              .agg(F.count(F.lit(1)).alias("num_orders")))
    rng = counts.agg(F.min("_p").alias("lo"), F.max("_p").alias("hi"))
    if period == "month":
        seq = F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), step)
        grid = rng.select(F.explode(seq).alias("_m")).select(F.last_day("_m").alias("_p"))
    else:
        grid = rng.select(F.explode(F.sequence("lo", "hi", step)).alias("_p"))
    return (grid.join(counts, "_p", "left")
            .select(F.col("_p").cast("timestamp_ntz").alias("period_end"),
                    F.coalesce(F.col("num_orders"), F.lit(0)).alias("num_orders")))


def top_values(df: DataFrame, column: str, k: int = 10, name: str = "num_users") -> DataFrame:
    """F16: the k most frequent non-null values."""
    agg = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return top_k(agg, name, column, k)

