"""Repairs (D1-D7): row filters and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.functions.nulls import is_member
from cartlens.operators.quality import empty_row_condition, matched, parent_keys


def fk_keep_null(child: DataFrame, parent: DataFrame, child_key: str,
                 parent_key: str) -> DataFrame:
    """Drop rows whose non-null key is missing from the parent; keep null keys."""
    rows = matched(child, parent, child_key, parent_key)
    return rows.where(F.col("_found") | F.col(child_key).isNull()).drop("_found")


def fk_strict(child: DataFrame, parent: DataFrame, child_key: str,
              parent_key: str) -> DataFrame:
    """Keep rows whose key is in the parent (null keys dropped)."""
    return child.join(parent_keys(parent, parent_key, child_key), child_key, "left_semi")


def fk_conditional(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                   status: str, exempt: str) -> DataFrame:
    """D3: keep rows with status == exempt, or whose key is in the parent."""
    exempted = F.coalesce(F.col(status) == F.lit(exempt), F.lit(False))
    rows = matched(child, parent, child_key, parent_key, ~exempted)
    return rows.where(F.col("_found") | exempted).drop("_found")


def latest_per_key(df: DataFrame, key: str, order: str, tiebreak: str) -> DataFrame:
    """One row per non-null key, the one sorted last by ``order``.

    A null ``order`` sorts last (counts as newest); ties go to the largest
    ``tiebreak``. A ``max_by`` aggregate: a hot key is reduced in the map tasks
    (after a sort there, as whole rows do not fit a hash aggregate's buffer)
    instead of being sorted in one window task.
    """
    cols = df.columns
    rank = F.struct(F.col(order).isNull().alias("_n"), F.col(order).alias("_o"),
                    F.col(tiebreak).alias("_t"))
    best = (df.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_row")))
    return best.select(*[F.col("_row")[c].alias(c) for c in cols])


def drop_empty_rows(df: DataFrame, status: str, exempt: str, user: str,
                    dates: list[str]) -> DataFrame:
    """Drop rows with the exempt status, no user and no dates."""
    return df.where(~empty_row_condition(status, exempt, user, dates))


def domain_filter(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Keep rows whose value is in the domain (null dropped)."""
    return df.where(is_member(column, domain))


def non_negative(df: DataFrame, column: str) -> DataFrame:
    """Keep rows with value >= 0 (null dropped)."""
    return df.where(F.col(column) >= 0)


def keep_where(df: DataFrame, column: str, predicate) -> DataFrame:
    """Keep rows whose (computed) ``column`` satisfies ``predicate(col)``.

    A plain ``where`` on a computed column is pushed below the projection
    with the column's expression substituted, so an expensive expression
    (a chain of regular expressions over long texts) runs twice. Filtering
    through a generator over a zero-or-one-element array keeps the value
    computed once; column order is preserved.
    """
    kept = F.explode(F.filter(F.array(F.col(column)), predicate)).alias(column)
    return df.select(*[kept if c == column else F.col(c) for c in df.columns])

