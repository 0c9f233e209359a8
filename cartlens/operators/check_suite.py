"""C1-C12 as one suite: every table is read once and all checks share one aggregate.

A row of a table says what it means to each check on it as a few (check, key)
entries: the missing key, the key that may be repeated, the key that refers to
another table, the value outside its domain. Entries of all tables are counted by
(check, key) in one grouped aggregate, in the map tasks first. A reference is met
there by the entries of its parent table under the same check, so there is no
join; a null key is an entry like any other, counted once per map task.

``counts`` gives the counted entries, from which ``report`` (one row per check) and
``violating_keys`` follow without another look at the tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.functions.nulls import is_member, ne
from cartlens.operators.quality import empty_row_condition
from cartlens.session import cut_lineage

_ENTRY = "struct<check_name:string,key:string,n:bigint,parents:bigint>"


@dataclass(frozen=True)
class Check:
    """One check of ``table``. By kind: ``null_key`` and ``duplicate`` of the columns; ``foreign_key`` of a column into
    ``parent`` (table, column), rows with ``exempt`` (column, value) left out; ``domain`` (``values``);
    ``missing`` and ``negative`` numbers; ``empty`` rows (status, exempt value, user, dates in ``columns``)."""
    name: str
    kind: str
    table: str
    columns: tuple[str, ...]
    parent: tuple[str, str] | None = None
    exempt: tuple[str, str] | None = None
    values: tuple[str, ...] = ()

    def entry(self) -> Column:
        """What a row of the table contributes (null: nothing)."""
        c = F.col(self.columns[0])
        # Keys of several columns: each with its length, so that no two lists have the same text.
        key = F.concat(*[F.coalesce(F.concat(F.length(F.col(x).cast("string")).cast("string"), F.lit(":"), F.col(x).cast("string")), F.lit("-"))
                         for x in self.columns]) if len(self.columns) > 1 else c.cast("string")
        says = {"null_key": c.isNull(), "duplicate": F.lit(True), "missing": c.isNull(), "negative": F.coalesce(c < 0, F.lit(False)),
                "domain": ~is_member(self.columns[0], list(self.values)),
                "foreign_key": ne(*self.exempt) if self.exempt else F.lit(True)}
        if self.kind == "empty":
            status, user, *dates = self.columns
            return F.when(empty_row_condition(status, self.values[0], user, dates), self._struct(F.lit(None), 1, 0))
        counted = key if self.kind in ("duplicate", "foreign_key", "domain") else F.lit(None)
        return F.when(says[self.kind], self._struct(counted, 1, 0))

    def parent_entry(self) -> Column:
        c = F.col(self.parent[1])
        return F.when(c.isNotNull(), self._struct(c.cast("string"), 0, 1))

    def _struct(self, key: Column, n: int, parents: int) -> Column:
        return F.struct(F.lit(self.name).alias("check_name"), key.cast("string").alias("key"), F.lit(n).cast("long").alias("n"),
                        F.lit(parents).cast("long").alias("parents"))


def counts(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(check_name, key, n, parents): rows of the checked table, and of the parent, by check and key. One scan per table."""
    parts = []
    for name in dict.fromkeys([c.table for c in checks] + [c.parent[0] for c in checks if c.parent]):
        entries = [c.entry() for c in checks if c.table == name] + [c.parent_entry() for c in checks if c.parent and c.parent[0] == name]
        said = F.filter(F.array(*entries), lambda e: e.isNotNull()).cast(f"array<{_ENTRY}>")
        parts.append(tables[name].select(F.inline(said)))
    every = reduce(DataFrame.unionAll, parts)
    return every.groupBy("check_name", "key").agg(F.sum("n").alias("n"), F.sum("parents").alias("parents"))


def _violates(checks: Sequence[Check]) -> Column:
    kinds = F.create_map(*[x for c in checks for x in (F.lit(c.name), F.lit(c.kind))])
    kind = F.element_at(kinds, F.col("check_name"))
    return F.when(kind == "duplicate", F.col("n") > 1).when(kind == "foreign_key", (F.col("n") > 0) & (F.col("parents") == 0)).otherwise(F.col("n") > 0)


def violating_keys(counted: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check_name, key, num_rows): keys or values that break a check (a null key is one) and their rows."""
    return counted.where(_violates(checks)).select("check_name", "key", F.col("n").alias("num_rows"))


def report(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``bad_keys`` (distinct, not null), ``bad_rows`` and, for references, ``matched_keys``
    (distinct keys with a parent) and ``matched_pairs`` (pairs of such a key and a parent row)."""
    bad, met = _violates(checks), (F.col("n") > 0) & (F.col("parents") > 0)
    found = counts(tables, checks).groupBy("check_name").agg(
        F.count_if(bad & F.col("key").isNotNull()).alias("bad_keys"), F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("bad_rows"),
        F.count_if(met).alias("matched_keys"), F.sum(F.when(met, F.col("parents")).otherwise(0)).alias("matched_pairs"))
    spark = next(iter(tables.values())).sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(c.name) for c in checks])).alias("check_name"))
    zero = {c: 0 for c in ("bad_keys", "bad_rows", "matched_keys", "matched_pairs")}
    return cut_lineage(names.join(F.broadcast(found), "check_name", "left").fillna(zero))  # one row per check
