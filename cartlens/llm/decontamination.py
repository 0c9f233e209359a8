"""Operator 3: benchmark decontamination by greedy string tiling.

Documents and benchmark items are read as words (letters and digits, A-Z
lower-cased, punctuation ignored; in scripts without spaces every character is a
word). A document meets an item where they share a
seed of ``MIN_TILE`` words. Their shared stretches are then tiled: running
Karp-Rabin hashes find the longest stretch that neither side has used yet, it
is marked on both, and so on down to ``MIN_TILE`` words. The item's share of
marked words is its coverage; from ``threshold`` on the document is contaminated
by it, also when the passages stand in another order.

The items are the stated query set: they go against every document in blocks of
at most ``BLOCK_WORDS`` words, each shipped to the tasks whole (that is the size
bound), and a document never leaves its task: no shuffle, no pairs.

Items of fewer than ``MIN_TILE`` words have no seed. With ``short`` they match as a
whole: a document that holds all their words in a row is contaminated, by one tile.

Defined cases: null or empty texts and texts without words are clean; an item
without words (or a null text) matches nothing, nor does one of fewer than
``MIN_TILE`` words without ``short``; repeated
rows and repeated items are judged each for itself; empty tables give empty
results (no item: everything is clean); documents of any length are read whole;
equal lengths are tiled by document position, then item position; carried
columns travel under positional names, so no name clashes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cartlens.llm import common

MIN_TILE, THRESHOLD = 5, 0.5
BLOCK_WORDS = 1_000_000
#: First search length of the tiling; longer stretches raise it.
START = 20


def read_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a pass, and the row of each."""
    s, e, row = common.tokens(data, offsets)
    return common.span_hash(common.prefix_hash(data, True), s, e), row


def _window_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of n words."""
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    up, down = common.powers(len(words))
    np.cumsum(words * up[:len(words)], out=sums[1:])
    return (sums[n:] - sums[:-n]) * down[:len(words) - n + 1]


def _free(used: np.ndarray, n: int) -> np.ndarray:
    """Whether each window of n words is wholly unused."""
    sums = np.concatenate([[0], np.cumsum(used)])
    return sums[n:] == sums[:-n]


def _longest(doc: np.ndarray, item: np.ndarray, used_d: np.ndarray, used_i: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Maximal unused common stretches of at least n words: (length, document start, item start)."""
    if n > min(len(doc), len(item)):
        return []
    at_d, at_i = np.flatnonzero(_free(used_d, n)), np.flatnonzero(_free(used_i, n))
    hash_d, hash_i = _window_hash(doc, n)[at_d], _window_hash(item, n)[at_i]
    order = np.argsort(hash_i, kind="stable")
    lo = np.searchsorted(hash_i[order], hash_d, side="left")
    hi = np.searchsorted(hash_i[order], hash_d, side="right")
    out = []
    for k in np.flatnonzero(hi > lo):
        d = int(at_d[k])
        for i in at_i[order[lo[k]:hi[k]]].tolist():
            if d and i and not used_d[d - 1] and not used_i[i - 1] and doc[d - 1] == item[i - 1]:
                continue  # part of a stretch that begins earlier
            most = min(len(doc) - d, len(item) - i)
            same = (doc[d:d + most] == item[i:i + most]) & ~used_d[d:d + most] & ~used_i[i:i + most]
            length = most if same.all() else int(same.argmin())
            if length >= n:
                out.append((length, d, i))
    return out


def tile(doc: np.ndarray, item: np.ndarray, shared: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word sequences: (length, document start, item start) of
    each tile. ``shared`` marks the document words inside a shared seed."""
    used_d, used_i = ~shared, np.zeros(len(item), dtype=bool)
    tiles: list[tuple[int, int, int]] = []
    n = max(least, min(START, len(item)))
    while True:
        found = _longest(doc, item, used_d, used_i, n)
        top = max((x[0] for x in found), default=0)
        if top > 2 * n:
            n = top
            continue
        blocked = False
        for length, d, i in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if used_d[d:d + length].any() or used_i[i:i + length].any():
                blocked = True  # search anew: what is left of it may be longer than the next one
                break
            used_d[d:d + length] = used_i[i:i + length] = True
            tiles.append((length, d, i))
        if blocked:
            continue
        if n == least:
            return tiles
        n = max(least, n // 2)


class Block:
    """A block of benchmark items with its seeds."""

    def __init__(self, ids: list, texts: list[str], short: bool = False):
        batch = pa.record_batch([pa.array(texts, pa.string())], names=["text"])
        data, offsets = common.text_column(batch, "text")
        words, row = read_words(data, offsets)
        n = np.bincount(row, minlength=len(ids))
        ends = np.cumsum(n)
        self.ids = ids
        self.items = [words[e - k:e] for e, k in zip(ends, n, strict=True)]
        long = n >= MIN_TILE
        seeds, owner = common.shingles(words, row, MIN_TILE, len(ids))
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = long[owner]
        order = np.argsort(seeds[keep], kind="stable")
        self.seeds, self.owner, self.place = seeds[keep][order], owner[keep][order], place[keep][order]
        self.short = []  # by number of words: whole items, sorted by hash, and whose they are
        for k in range(1, MIN_TILE) if short else ():
            whole, owner = common.shingles(words, row, k, len(ids))
            keep = n[owner] == k
            order = np.argsort(whole[keep], kind="stable")
            if len(order):
                self.short.append((k, whole[keep][order], owner[keep][order]))

    def short_hits(self, words: np.ndarray, row: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """The rows that hold a short item whole."""
        for k, whole, items in self.short:
            found, owner = common.shingles(words, row, k, len(n))
            lo, hi = np.searchsorted(whole, found, "left"), np.searchsorted(whole, found, "right")
            met = np.flatnonzero((hi > lo) & (n[owner] >= k))
            if len(met):
                for r, a, b in np.unique(np.stack([owner[met], lo[met], hi[met]]), axis=1).T.tolist():
                    for i in items[a:b].tolist():
                        yield r, i, 1.0, 1, k

    def hits(self, data: np.ndarray, offsets: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float, int, int]]:
        """(row, item, coverage, tiles, longest tile) of the contaminated rows of a pass."""
        if not len(self.seeds) and not self.short:
            return
        words, row = read_words(data, offsets)
        n = np.bincount(row, minlength=len(offsets) - 1)
        if threshold <= 1:
            yield from self.short_hits(words, row, n)
        if not len(self.seeds):
            return
        first = np.cumsum(n) - n
        seeds, owner = common.shingles(words, row, MIN_TILE, len(n))
        at = np.minimum(np.searchsorted(self.seeds, seeds), len(self.seeds) - 1)
        met = np.flatnonzero((self.seeds[at] == seeds) & (n[owner] >= MIN_TILE))
        start = np.cumsum(np.maximum(n - MIN_TILE + 1, n > 0)) - np.maximum(n - MIN_TILE + 1, n > 0)
        for r in np.unique(owner[met]).tolist():
            mine = met[owner[met] == r]
            lo, hi = np.searchsorted(self.seeds, seeds[mine], "left"), np.searchsorted(self.seeds, seeds[mine], "right")
            doc = words[first[r]:first[r] + n[r]]
            spots: dict[int, list[tuple[int, int]]] = {}
            for p, a, b in zip((mine - start[r]).tolist(), lo.tolist(), hi.tolist(), strict=True):
                for k in range(a, b):
                    spots.setdefault(int(self.owner[k]), []).append((p, int(self.place[k])))
            for i, found in spots.items():
                item = self.items[i]
                inside, covered = np.zeros(len(doc), dtype=bool), np.zeros(len(item), dtype=bool)
                for p, q in found:
                    inside[p:p + MIN_TILE] = covered[q:q + MIN_TILE] = True
                if covered.sum() < threshold * len(item):
                    continue  # the tiles lie within the seeds: they cannot cover enough
                near = np.flatnonzero(inside)
                cut = np.flatnonzero(np.diff(near) > 1) + 1  # keep one unused word between separate stretches
                shared = np.ones(len(near) + len(cut), dtype=bool)
                shared[cut + np.arange(len(cut))] = False
                piece = np.zeros(len(shared), dtype=np.uint64)
                piece[shared] = doc[near]
                tiles = tile(piece, item, shared)
                coverage = sum(t[0] for t in tiles) / len(item)
                if coverage >= threshold:
                    yield r, i, coverage, len(tiles), max(t[0] for t in tiles)


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", short: bool = False) -> Iterator[Block]:
    """The benchmark in blocks of at most ``BLOCK_WORDS`` words on average, one at a time on the driver."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // (2 * BLOCK_WORDS)) or 1
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).collect()
        yield Block([r["id"] for r in rows], [r["text"] for r in rows], short)


def _passes(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = common.text_column(batch, "text")
    for lo, hi in common.passes(offsets):
        yield lo, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD, short: bool = False) -> DataFrame:
    """A row for each contaminated document and item: ``id_col``, item_id, coverage, n_tiles, longest_tile."""
    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    doc_type, item_type = dict(rows.dtypes)["id"], dict(benchmark.dtypes)["item_id"]
    item_arrow = to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = f"id {doc_type}, item_id {item_type}, coverage double, n_tiles int, longest_tile int"
    out = None
    for block in blocks(benchmark, short=short):
        shipped = spark.sparkContext.broadcast(block)  # at most BLOCK_WORDS words

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            common.enter("decontamination")
            for b in batches:
                found = [(lo + r, *rest) for lo, data, offsets in _passes(b)
                         for r, *rest in shipped.value.hits(data, offsets, threshold)]
                if found:
                    row, item, *rest = zip(*found, strict=True)
                    ids = pa.array([shipped.value.ids[i] for i in item], item_arrow)
                    yield pa.record_batch([b.column(0).take(pa.array(row)), ids, pa.array(rest[0], pa.float64()),
                                           pa.array(rest[1], pa.int32()), pa.array(rest[2], pa.int32())],
                                          names=["id", "item_id", "coverage", "n_tiles", "longest_tile"])

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out.withColumnRenamed("id", id_col)


def drop(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", threshold: float = THRESHOLD,
         short: bool = False) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept."""
    common.ship(docs.sparkSession)
    names: Sequence[str] = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    schema, at = rows.schema, names.index(text_col)
    for block in blocks(benchmark, short=short):
        shipped = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            common.enter("decontamination")
            for b in batches:
                keep = np.ones(b.num_rows, dtype=bool)
                for lo, data, offsets in _passes(pa.record_batch([b.column(at)], names=["text"])):
                    for r, *_ in shipped.value.hits(data, offsets, threshold):
                        keep[lo + r] = False
                yield b.filter(pa.array(keep))

        rows = rows.mapInArrow(run, schema)
    return rows.toDF(*names)
