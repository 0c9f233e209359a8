"""Data-quality reports (C1-C12). They read tables and never change them.

Every report is one aggregation or one anti/semi join; parent keys are
deduplicated (partial aggregation) before any join so a hot duplicated parent
key cannot fan out or pile up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.functions.nulls import is_member, ne


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def parent_keys(parent: DataFrame, parent_key: str, as_name: str) -> DataFrame:
    """Distinct non-null parent keys (map-side combined)."""
    return (parent.select(F.col(parent_key).alias(as_name))
            .where(F.col(as_name).isNotNull()).distinct())


def matched(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, checked=None) -> DataFrame:
    """``child`` with ``_found``: whether its key is in the parent. One pass over the child: rows without
    a key (or outside ``checked``) get a key of their own that no parent has, so that they
    spread over the join's tasks instead of meeting in one."""
    key = F.col(child_key)
    asks = key.isNotNull() if checked is None else key.isNotNull() & checked
    own = F.concat(F.lit("\0"), F.xxhash64(*[F.col(f"`{c}`") for c in child.columns]).cast("string"))
    pk = parent_keys(parent, parent_key, "_pk").select(F.col("_pk").cast("string").alias("_pk"))
    rows = child.withColumn("_ck", F.when(asks, key.cast("string")).otherwise(own))
    return (rows.join(pk, F.col("_ck") == F.col("_pk"), "left")
            .withColumn("_found", F.col("_pk").isNotNull()).drop("_ck", "_pk"))


def null_key_count(df: DataFrame, key: str, name: str = "null_keys") -> DataFrame:
    """Number of rows whose key is null."""
    return df.agg(F.count_if(F.col(key).isNull()).alias(name))


def duplicate_keys(df: DataFrame, key, name: str = "num_rows") -> DataFrame:
    """Key values (null is a group) held by more than one row."""
    return (df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias(name))
            .where(F.col(name) > 1))


def fk_coverage(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                flag: str = "in_parent") -> DataFrame:
    """C4: distinct non-null child keys left-joined to parent keys, grouped by
    the match flag (1.0 / null), groups with more than one row.

    The parent is not deduplicated in the reference, so a child key matching k
    parent rows counts k times. That multiplicity is computed by a grouped
    count of the parent, never by a fanning-out join.
    """
    ck = (child.select(F.col(child_key).alias("_k")).where(F.col("_k").isNotNull()).distinct())
    pk = (parent.select(F.col(parent_key).alias("_k")).where(F.col("_k").isNotNull())
          .groupBy("_k").agg(F.count(F.lit(1)).alias("_mult")))
    j = ck.join(pk, "_k", "left")
    return (j.groupBy(F.when(F.col("_mult").isNotNull(), F.lit(1.0)).alias(flag))
            .agg(F.sum(F.coalesce(F.col("_mult"), F.lit(1))).cast("long").alias("num_rows"))
            .where(F.col("num_rows") > 1))


def fk_orphan_keys(child: DataFrame, parent: DataFrame, child_key: str,
                   parent_key: str) -> DataFrame:
    """Distinct non-null child keys missing from the parent."""
    ck = child.select(child_key).where(F.col(child_key).isNotNull()).distinct()
    return ck.join(parent_keys(parent, parent_key, child_key), child_key, "left_anti")


def fk_orphan_rows(child: DataFrame, parent: DataFrame, child_key: str,
                   parent_key: str) -> DataFrame:
    """Child rows whose non-null key is missing from the parent."""
    return (child.where(F.col(child_key).isNotNull())
            .join(parent_keys(parent, parent_key, child_key), child_key, "left_anti"))


def fk_violation_count(child: DataFrame, parent: DataFrame, child_key: str,
                       parent_key: str, name: str = "violations") -> DataFrame:
    """Rows whose key is not in the parent; a null key counts as a violation."""
    return _violations(child.select(child_key), parent, child_key, parent_key, name)


def _violations(keys: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                name: str) -> DataFrame:
    """Keys are counted in the map tasks, so a hot key or the null key is one row of the join; a null key
    finds no parent and is a violation by definition."""
    per = keys.groupBy(F.col(child_key).alias("_ck")).agg(F.count(F.lit(1)).alias("_n"))
    found = per.join(parent_keys(parent, parent_key, "_pk"), F.col("_ck") == F.col("_pk"), "left")
    return found.agg(F.coalesce(F.sum(F.when(F.col("_pk").isNull(), F.col("_n"))), F.lit(0)).alias(name))


def conditional_fk_count(child: DataFrame, parent: DataFrame, child_key: str,
                         parent_key: str, status: str, exempt: str,
                         name: str = "violations") -> DataFrame:
    """Rows with status != exempt (null status included) and key not in parent."""
    return _violations(child.where(ne(status, exempt)).select(child_key), parent,
                       child_key, parent_key, name)


def domain_violations(df: DataFrame, column: str, domain: list[str],
                      name: str = "violations") -> DataFrame:
    """Rows whose value is outside the domain; null counts."""
    return df.agg(F.count_if(~is_member(column, domain)).alias(name))


def numeric_range(df: DataFrame, column: str) -> DataFrame:
    """Missing and negative counts of a numeric column."""
    c = F.col(column)
    return df.agg(F.count_if(c.isNull()).alias("missing"),
                  F.count_if(c < 0).alias("negative"))


def empty_row_condition(status: str, exempt: str, user: str, dates: list[str]):
    """Cards with no information: exempt status, no user, no dates (null-safe)."""
    u = F.col(user)
    cond = F.coalesce(F.col(status) == F.lit(exempt), F.lit(False))
    cond = cond & (u.isNull() | F.coalesce(u.cast("string") == F.lit(""), F.lit(False)))
    for d in dates:
        cond = cond & F.col(d).isNull()
    return cond


def empty_row_count(df: DataFrame, status: str, exempt: str, user: str,
                    dates: list[str], name: str = "empty_rows") -> DataFrame:
    """Number of empty rows."""
    return df.agg(F.count_if(empty_row_condition(status, exempt, user, dates)).alias(name))


def json_validity(df: DataFrame, columns: list[str]) -> DataFrame:
    """B3 as a report: per column, non-null values that are not valid JSON."""
    from cartlens.functions.text import is_invalid_json
    return df.agg(*[F.count_if(is_invalid_json(c)).alias(f"{c}_invalid") for c in columns])


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """One row with the table name, row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("num_rows")).select(
        F.lit(name).alias("table_name"), "num_rows",
        F.lit(len(df.columns)).cast("int").alias("num_columns"))


def preview(df: DataFrame, name: str, order_by: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (missing values last) as text, in order, with the table's column list. ``n`` is
    the feature: Spark keeps the best ``n`` rows of each task and merges them."""
    order = [F.col(c).asc_nulls_last() for c in order_by]
    text = F.concat_ws(" | ", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("<missing>")) for c in df.columns])
    first = df.orderBy(*order).limit(n)
    return first.select(F.lit(name).alias("table_name"), F.row_number().over(Window.orderBy(*order)).alias("row_no"),
                        F.lit(", ".join(df.columns)).alias("columns"), text.alias("row_text"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A2: distinct values of a column with their row counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("num_rows"))
