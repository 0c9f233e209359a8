"""Operator 9: exact top-k search by inner product with a pivot table.

Vectors are made integers (``floor(256 * x)``), so scores are exact. Every
candidate's distances to a set of pivots (the origin among them) are computed
once per block; for a query, the largest difference of distances to a pivot is
a lower bound of its distance to a candidate, which with the two norms gives an
upper bound of the inner product. Candidates are evaluated in the order of that
bound until the next bound is below the k-th best score found: nothing that
could still enter, ties included, is left out.

Candidates are dealt into blocks of at most ``BLOCK`` rows by id hash; the query
set goes to every block, in rows that a task reads as a stream after the
block's candidates; each block answers with its k best per query, and the best
of those are ranked at the end.

Defined cases: vectors that are null, empty or hold a null or non-finite
component, and rows without an id, take no part; vectors meet only vectors of
their own length; equal queries (id and vector) are asked once, a query never
meets rows of its own id, other repeated rows each count; ties go to the smaller
id; an empty table gives an empty result; components and scores beyond 64 bits
are held at its limits; only the id and vector columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import ship

BLOCK, PIVOTS = 65_536, 24
#: Candidates evaluated together, and queries whose bounds are held together.
STEP, QUERY_BATCH = 256, 128
_LIMIT = 2**53


def quantised(embedding: Column, factor: int = 256) -> Column:
    """Integer components; null where the vector takes no part."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * factor).cast("long"))
    return F.when(embedding.isNotNull() & (F.size(embedding) > 0) & ~bad, whole)


class Candidates:
    """The candidates of one block and one vector length, with their pivot table."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray):
        self.ids, self.vectors, self.pivots = ids, vectors, pivots.astype(np.float64)
        self.most = int(max(abs(int(vectors.min())), abs(int(vectors.max())))) if len(vectors) else 0
        self.real = vectors.astype(np.float64)
        self.norm = (self.real ** 2).sum(axis=1)
        self.table = self._distances(self.real, self.norm)

    def _distances(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        square = norm[:, None] + (self.pivots ** 2).sum(axis=1) - 2 * x @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of every query's score with every candidate."""
        q = queries.astype(np.float64)
        norm = (q ** 2).sum(axis=1)
        away = self._distances(q, norm)
        low = np.zeros((len(q), len(self.ids)))
        for p in range(len(self.pivots)):
            np.maximum(low, np.abs(away[:, p, None] - self.table[:, p]), out=low)
        both = norm[:, None] + self.norm
        return (both - low ** 2) / 2 + (1e-9 * both + 1)  # the last term is above any rounding

    def scores(self, query: np.ndarray, which: np.ndarray) -> np.ndarray:
        size = self.most * int(max(abs(int(query.min())), abs(int(query.max())))) * len(query)
        if size < _LIMIT:  # every partial sum is a whole number that a double holds exactly
            return (self.real[which] @ query.astype(np.float64)).astype(np.int64)
        exact = [sum(a * b for a, b in zip(v, query.tolist(), strict=True)) for v in self.vectors[which].tolist()]
        return np.array([min(max(x, -2**63), 2**63 - 1) for x in exact], dtype=np.int64)

    def best(self, query_id: int, query: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (id, score) for one query: evaluate in bound order until no bound reaches the k-th score."""
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bound = np.where(self.ids == query_id, -np.inf, bound)
        rest = np.arange(len(bound))
        while len(rest):
            if len(rest) > STEP:
                part = np.argpartition(-bound[rest], STEP - 1)
                now, rest = rest[part[:STEP]], rest[part[STEP:]]
            else:
                now, rest = rest, rest[:0]
            now = now[bound[now] > -np.inf]
            ids, scores = np.concatenate([ids, self.ids[now]]), np.concatenate([scores, self.scores(query, now)])
            top = np.lexsort((ids, -scores.astype(object) if len(scores) and scores.min() == -2**63 else -scores))[:k]
            ids, scores = ids[top], scores[top]
            if len(ids) == k:
                rest = rest[bound[rest] >= scores[-1]]
        return ids, scores


def _vectors(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = col.value_lengths().to_numpy(zero_copy_only=False)
    return lengths, col.flatten().to_numpy(zero_copy_only=False)


def _by_length(ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    start = np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == d)
        yield d, own, flat[start[own][:, None] + np.arange(d)]


def top_k(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          factor: int = 256) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows."""
    spark = rows.sparkSession
    ship(spark)
    vectors = (rows.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), factor).alias("v"),
                           is_query.alias("asked"))
               .where(F.col("id").isNotNull() & F.col("v").isNotNull()))
    n = rows.count()
    n_blocks = max(spark.sparkContext.defaultParallelism, -(-n // BLOCK))
    chosen = [np.array(r["v"], dtype=np.int64) for r in  # a fixed number of rows, whatever the table
              vectors.orderBy(F.xxhash64("id", "v"), "id").limit(PIVOTS).collect()]
    pivots = {d: np.array([np.zeros(d, np.int64), *[p for p in chosen if len(p) == d]]) for d in {len(p) for p in chosen}}

    candidates = vectors.select(F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)).alias("block"), F.lit(0).alias("kind"),
                                "id", "v")
    queries = (vectors.where("asked").select("id", "v").dropDuplicates()
               .select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"),
                       F.lit(1).alias("kind"), "id", "v"))
    dealt = (candidates.unionAll(queries).repartitionById(n_blocks, F.col("block").cast("int"))
             .sortWithinPartitions("block", "kind"))

    def answer(blocks: dict[int, Candidates], ids: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> Iterator[pa.RecordBatch]:
        for d, own, q in _by_length(ids, lengths, flat):
            if d not in blocks:
                continue
            for lo in range(0, len(own), QUERY_BATCH):
                part, asked = q[lo:lo + QUERY_BATCH], ids[own[lo:lo + QUERY_BATCH]].tolist()
                out: list[list[int]] = [[], [], [], []]
                for query_id, query, bound in zip(asked, part, blocks[d].bounds(part), strict=True):
                    best, scores = blocks[d].best(query_id, query, bound, k)
                    digest = int.from_bytes(hashlib.sha256(query.tobytes()).digest()[:8], "big", signed=True)
                    for column, values in zip(out, ([query_id] * len(best), [digest] * len(best), best.tolist(), scores.tolist()),
                                              strict=True):
                        column += values
                yield pa.record_batch([pa.array(c, pa.int64()) for c in out], names=["query_id", "query", "vec_id", "score"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ready = None, [], None
        for b in batches:
            blocks_, kinds = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(blocks_) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows], strict=True):
                if not hi:
                    continue
                part = b.slice(lo, hi - lo)
                if block != blocks_[lo]:
                    block, held, ready = blocks_[lo], [], None
                if kinds[lo] == 0:
                    held.append(part)
                    continue
                if ready is None:
                    t = pa.Table.from_batches(held).combine_chunks() if held else None
                    ready = {}
                    if t is not None:
                        ids, (lengths, flat) = t.column(2).to_numpy(), _vectors(t.column(3).combine_chunks())
                        for d, own, v in _by_length(ids, lengths, flat):
                            ready[d] = Candidates(ids[own], v, pivots.get(d, np.zeros((1, d), np.int64)))
                    held = []
                yield from answer(ready, part.column(2).to_numpy(), *_vectors(part.column(3)))

    found = dealt.mapInArrow(search, "query_id long, query long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
