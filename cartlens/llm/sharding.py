"""Operator 6: shard placement by a permutation-filled lookup table.

Every shard has a preference order over the slots of a prime-sized table
(offset + i * skip, both taken from hashes of its name). Shards take turns, in
proportion to their weights, and claim the next free slot of their order until
the table is full. A key's hash picks its slot, so placement is one look-up in
a broadcast table of ``size`` rows (its size bound, at most ``MAX_SLOTS``), and
adding or removing a shard moves few keys.

Defined cases: a null key is hashed as the text ``null`` preceded by a zero
character, so all null keys share a slot unless a second key column is named;
repeated rows get the same shard; empty tables give empty results; texts are
not read; only the named key columns are read, so no other column can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SLOTS = 1_000_003


def _hash(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: Sequence[str], size: int, weights: Sequence[float] | None = None) -> list[int]:
    """Index into ``shards`` of each slot. ``size`` is a prime, at least the number of shards."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not is_prime(size) or not len(shards) <= size <= MAX_SLOTS:
        raise ValueError(f"size must be a prime from {len(shards)} to {MAX_SLOTS}")
    weights = list(weights or [1.0] * len(shards))
    if len(weights) != len(shards) or min(weights) <= 0:
        raise ValueError("one positive weight per shard")
    at = [_hash(s, "offset") % size for s in shards]
    skip = [_hash(s, "skip") % (size - 1) + 1 for s in shards]
    credit, top = [0.0] * len(shards), max(weights)
    table, left = [-1] * size, size
    while left:
        for i, w in enumerate(weights):
            credit[i] += w / top
            if credit[i] < 1.0:
                continue
            credit[i] -= 1.0
            while table[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def slot(keys: Sequence[str | Column], size: int) -> Column:
    text = F.concat_ws(":", *[F.coalesce(F.col(k).cast("string") if isinstance(k, str) else k.cast("string"),
                                         F.lit("\0null")) for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def _array(table: Sequence[int]) -> Column:
    """The table as one array column (written as text: one literal, not one per slot)."""
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")


def place(rows: DataFrame, shards: Sequence[str], size: int, keys: Sequence[str] = ("doc_id",),
          weights: Sequence[float] | None = None) -> DataFrame:
    """``keys``, slot and shard name of every row."""
    if clash := {"slot", "shard"} & {k.lower() for k in keys}:
        raise ValueError(f"a key has the name of a result column: {', '.join(sorted(clash))}")
    table = lookup_table(shards, size, weights)
    names = F.array(*map(F.lit, shards))
    slots = (rows.sparkSession.range(1)
             .select(F.posexplode(_array(table)).alias("slot", "index"))
             .select("slot", F.get(names, "index").alias("shard")))
    keyed = rows.select(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)], slot(keys, size).alias("slot"))
    return (keyed.join(F.broadcast(slots), "slot")
            .select(*[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)], "slot", "shard"))


def write_shards(rows: DataFrame, path: str, shards: Sequence[str], size: int, files_per_shard: int = 8,
                 key: str = "doc_id") -> None:
    """Write whole rows below ``path``, one folder ``shard=...`` each; a shard's rows go
    through ``files_per_shard`` tasks, dealt by row hash, so a hot key is split."""
    clash = [c for c in rows.columns if c.lower() == "shard"]
    if clash:
        raise ValueError("the rows already have a column named shard")
    table = lookup_table(shards, size)
    names = F.array(*map(F.lit, shards))
    shard = F.get(names, F.get(_array(table), slot([key], size)))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(files_per_shard))
    (rows.withColumn("shard", shard).repartition(len(shards) * files_per_shard, "shard", salt)
     .write.partitionBy("shard").mode("error").parquet(path))
