"""Operator 13: hard negatives from Hilbert-ordered blocks with zone maps.

Candidates are sorted by label and by their place on a Hilbert curve through the
space of vectors and written as Parquet in blocks of at most ``BLOCK`` rows. A
block's zone map holds the least and largest value of every dimension and its
labels. For an anchor a, interval arithmetic turns a zone map into bounds of all
inner products with the block's rows: sum of min(a_d * low_d, a_d * high_d) and
of max(...). The bounds decide which blocks are read:

1. An anchor's own block gives it a first score that its positives must reach.
   Blocks that may hold its label and whose upper bound reaches that score are
   read; the best k rows are its positives.
2. Every positive opens a window of scores. Blocks that may hold another label and
   whose bounds meet a window are read, and the best rows inside each are its
   hard negatives.

Blocks are read in chunks: an anchor goes only to the chunks where a block was
chosen for it, where it meets its blocks in the order of their bounds; a block
whose bound cannot beat what is found already is skipped. Nothing else is left
out, so the result is exact.

Defined cases: rows with a null id, a null label or a vector that is null, empty
or holds a null or non-finite component take no part; vectors meet only vectors of
their own length; equal anchors (id, label and vector) are asked once; an anchor
never meets rows of its own id, other repeated rows each count; ties go to the
smaller id; anchors without positives, and positives without a row in the window,
give no row; a negative score opens no window (its bounds cross); scores beyond 64
bits are held at the limits; an empty table gives an empty result; only the named
columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import ship, stored
from cartlens.llm.vector_search import quantised

#: Rows of a block, of a chunk of blocks, zone maps compared by one task, anchors handled together.
BLOCK, CHUNK, ZONES, ANCHORS = 512, 65_536, 8_192, 128
#: Bits of the Hilbert curve in each dimension.
BITS = 4
_EXACT, _CODE = 2**53, 1 << 24
_LOW, _HIGH = -2**63, 2**63 - 1


def hilbert_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """Place on the Hilbert curve of each row of cell numbers in [0, 2**bits): keys that sort as bytes."""
    x = cells.astype(np.uint32).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):  # undo the turns of the finer levels
        q = np.uint32(1 << level)
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap).astype(np.uint32)
            if i:
                x[i] ^= swap.astype(np.uint32)
    x = np.bitwise_xor.accumulate(x, axis=0)  # Gray code
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[n - 1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turn
    levels = [(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return [row.tobytes() for row in np.packbits(np.concatenate(levels).T.astype(np.uint8), axis=1)]


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products (rows x anchors) as 64-bit integers, held at their limits."""
    def most(a):
        return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0
    if most(rows) * most(anchors) * rows.shape[1] < _EXACT:  # every partial sum is exact in a double
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    whole = rows.astype(object) @ anchors.astype(object).T
    return np.clip(whole, _LOW, _HIGH).astype(np.int64)


def bounds(low: np.ndarray, high: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible inner product (anchors x boxes), widened by any rounding."""
    a, lo, hi = anchors.astype(np.float64), low.astype(np.float64), high.astype(np.float64)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    slack = 1 + 1e-12 * (np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T)
    return up @ lo.T + down @ hi.T - slack, up @ hi.T + down @ lo.T + slack


def first_rows(scores: np.ndarray, allowed: np.ndarray, k: int) -> list[np.ndarray]:
    """Per column, the rows of the k largest allowed scores; equal scores: the earlier row."""
    n = len(scores)
    if n == 0 or not scores.shape[1]:
        return [np.zeros(0, np.int64)] * scores.shape[1]
    if max(abs(int(scores.min())), abs(int(scores.max()))) < 2**62 // n:
        key = np.where(allowed, scores * n + (n - 1 - np.arange(n))[:, None], _LOW)  # score first, then the earlier row
        if n > k:
            key = np.partition(key, n - k, axis=0)[n - k:]
        key = -np.sort(-key, axis=0) if key.min() > _LOW else np.sort(key, axis=0)[::-1]
        return [n - 1 - (c[c > _LOW] % n) for c in key.T]
    out = []
    for c in range(scores.shape[1]):
        own = np.flatnonzero(allowed[:, c])
        out.append(own[np.argsort(~scores[own, c], kind="stable")[:k]])  # ~ reverses the order and cannot overflow
    return out


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _matrix(col: pa.Array, own: np.ndarray, d: int) -> np.ndarray:
    lengths = col.value_lengths().to_numpy(zero_copy_only=False)
    start = np.cumsum(lengths) - lengths
    return col.flatten().to_numpy(zero_copy_only=False)[start[own][:, None] + np.arange(d)]


def _same(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of consecutive rows that agree in all columns."""
    n = len(columns[0])
    if not n:
        return []
    change = np.zeros(n - 1, bool)
    for c in columns:
        change |= c[1:] != c[:-1]
    cuts = np.flatnonzero(change) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), n], strict=True))


_BLOCKS = "code long, part long, id long, label long, v array<long>"


def hilbert_blocks(rows: DataFrame) -> DataFrame:
    """Write ``rows`` (id, label, v) by length, label and curve as blocks: code (part and block), part, id, label, v.
    The curve's cells split the range of all components evenly."""
    spark = rows.sparkSession
    edge = rows.agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"), F.count("*").alias("n")).first()
    low, high = float(edge["low"] or 0), float(edge["high"] or 0)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            keys: list[bytes] = [b""] * b.num_rows
            for d in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == d)
                cells = (_matrix(b.column(2), own, d).astype(np.float64) - low) / max(high - low, 1) * (1 << BITS)
                for i, key in zip(own.tolist(), hilbert_keys(np.clip(cells, 0, (1 << BITS) - 1), BITS), strict=True):
                    keys[i] = key
            yield pa.record_batch([pa.array(lengths, pa.int32()), *b.columns, pa.array(keys, pa.binary())],
                                  names=["d", "id", "label", "v", "place"])

    order = ["d", "label", "place", "id"]
    n_parts = max(spark.sparkContext.defaultParallelism, -(-edge["n"] // CHUNK))
    placed = stored(rows.mapInArrow(keyed, "d int, id long, label long, v array<long>, place binary"), "curve")  # read for the ranges, too
    dealt = placed.repartitionByRange(n_parts, *order).sortWithinPartitions(*order).select("d", "id", "label", "v")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, size, last = TaskContext.get().partitionId(), 0, 0, None
        for b in batches:
            codes = np.empty(b.num_rows, np.int64)
            for lo, hi in _same(b.column(0).to_numpy()):
                d = b.column(0)[lo].as_py()
                if last is not None and d != last:
                    block, size = block + 1, 0
                last = d
                at = size + np.arange(hi - lo)
                codes[lo:hi] = block + at // BLOCK
                block, size = block + (size + hi - lo) // BLOCK, (size + hi - lo) % BLOCK
            yield pa.record_batch([pa.array(codes + part * _CODE), pa.array([part] * b.num_rows, pa.int64()), *b.columns[1:]],
                                  names=["code", "part", "id", "label", "v"])

    return stored(dealt.mapInArrow(numbered, _BLOCKS), "blocks")


def zone_maps(blocks: DataFrame) -> DataFrame:
    """Per block (or part of one, where a file is read in pieces): the range of its labels and of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, part, label, vectors = *(_column(b, c).to_numpy() for c in ("code", "part", "label")), _column(b, "v")
            ranges = _same(code)
            low, high = [], []
            for lo, hi in ranges:
                v = _matrix(vectors.slice(lo, hi - lo), np.arange(hi - lo), len(vectors[lo]))
                low.append(v.min(axis=0))
                high.append(v.max(axis=0))
            first = [lo for lo, _ in ranges]
            yield pa.record_batch([pa.array(code[first]), pa.array(part[first]), pa.array([label[lo:hi].min() for lo, hi in ranges], pa.int64()),
                                   pa.array([label[lo:hi].max() for lo, hi in ranges], pa.int64()), pa.array(low, pa.list_(pa.int64())),
                                   pa.array(high, pa.list_(pa.int64()))], names=["code", "part", "l0", "l1", "low", "high"])

    return stored(blocks.mapInArrow(run, "code long, part long, l0 long, l1 long, low array<long>, high array<long>"), "zones")


def first_scores(blocks: DataFrame, asked: Column, k: int) -> DataFrame:
    """Anchors (id, label, v) with the score that their k-th positive reaches at least: the k-th best in their own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, ids, label, ask = (_column(b, c).to_numpy(zero_copy_only=False) for c in ("code", "id", "label", "asked"))
            for lo, hi in _same(code):
                own = lo + np.flatnonzero(ask[lo:hi])
                if not len(own):
                    continue
                d = len(_column(b, "v")[lo])
                v = _matrix(_column(b, "v").slice(lo, hi - lo), np.arange(hi - lo), d)
                scores = products(v, v[own - lo])
                allowed = (label[lo:hi, None] == label[own]) & (ids[lo:hi, None] != ids[own])
                best = first_rows(scores, allowed, k)
                least = [int(scores[r[-1], i]) if len(r) == k else _LOW for i, r in enumerate(best)]
                at = pa.array(own)
                yield pa.record_batch([*[_column(b, c).take(at) for c in ("id", "label", "v")], pa.array(least, pa.int64())],
                                      names=["id", "label", "v", "least"])

    found = blocks.withColumn("asked", asked).mapInArrow(run, "id long, label long, v array<long>, least long")
    return found.groupBy("id", "label", "v").agg(F.max("least").alias("least"))


def _dealt(table: DataFrame, anchors: DataFrame, n: int, key: str) -> DataFrame:
    """Rows of ``table`` (kind 0) and ``anchors`` (kind 1) by ``key``, tables before anchors within each key."""
    both = table.withColumn("kind", F.lit(0)).unionByName(anchors.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartitionById(n, F.col(key).cast("int")).sortWithinPartitions(key, "kind")


def _streams(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[list[pa.RecordBatch] | None, pa.RecordBatch | None]]:
    """For each key its table's batches once (a list, and None), then its anchors batch by batch (None, and a batch)."""
    last, held, told = None, [], False
    for b in batches:
        keys, kinds = (_column(b, c).to_numpy() for c in (key, "kind"))
        for lo, hi in _same(keys, kinds):
            if keys[lo] != last:
                last, held, told = keys[lo], [], False
            if kinds[lo] == 0:
                held.append(b.slice(lo, hi - lo))
                continue
            if not told:
                yield held, None
                held, told = [], True
            for at in range(lo, hi, ANCHORS):
                yield None, b.slice(at, min(ANCHORS, hi - at))


def _columns(parts: list[pa.RecordBatch], *names: str) -> list[pa.Array]:
    t = pa.Table.from_batches(parts).combine_chunks()
    return [t.column(c).combine_chunks() for c in names]


def _by_length(col: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    lengths = col.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        yield d, np.flatnonzero(lengths == d)


def chosen_blocks(zones: DataFrame, anchors: DataFrame, n_zones: int, needed: Callable) -> DataFrame:
    """Per anchor and chunk, the codes of the blocks to read: those for which ``needed`` says so by label and bounds.
    Zone maps are compared in groups; every anchor goes to every group of zone maps, not of rows."""
    spark = zones.sparkSession
    n = max(spark.sparkContext.defaultParallelism, -(-n_zones // ZONES))
    groups = zones.withColumn("grp", F.pmod(F.xxhash64("code"), F.lit(n)))
    asked = anchors.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("grp"))
    carried = [c for c in anchors.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes: dict = {}
        for table, asks in _streams(batches, "grp"):
            if table is not None:
                boxes = {}
                if table:
                    code, chunk, l0, l1, low, high = _columns(table, "code", "chunk", "l0", "l1", "low", "high")
                    plain = [c.to_numpy() for c in (code, chunk, l0, l1)]
                    for d, own in _by_length(low):
                        boxes[d] = *[c[own] for c in plain], _matrix(low, own, d), _matrix(high, own, d)
                continue
            v = _column(asks, "v")
            for d, own in _by_length(v):
                if d not in boxes:
                    continue
                code, chunk, l0, l1, low, high = boxes[d]
                part = asks.take(pa.array(own))
                under, over = bounds(low, high, _matrix(v, own, d))
                yes = needed(part, l0, l1, under, over)
                who, block = np.nonzero(yes)
                order = np.lexsort((code[block], chunk[block], who))
                first = [lo for lo, _ in _same(who[order], code[block[order]])]  # a block may have more than one zone map
                who, block = who[order][first], block[order][first]
                ranges = _same(who, chunk[block])
                first = np.array([lo for lo, _ in ranges], np.int64)
                at = pa.array(np.append(first, len(who)), pa.int32())
                cols = [_column(part, c).take(pa.array(who[first])) for c in carried]
                yield pa.record_batch([*cols, pa.array(chunk[block[first]]), pa.ListArray.from_arrays(at, pa.array(code[block]))],
                                      names=[*carried, "chunk", "codes"])

    schema = ", ".join(f"{c} {t}" for c, t in anchors.dtypes) + ", chunk long, codes array<long>"
    return _dealt(groups, asked, n, "grp").mapInArrow(run, schema)


class Chunk:
    """The chosen blocks of one chunk that were read, rows by id, with their boxes."""

    def __init__(self, parts: list[pa.RecordBatch]):
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        if not parts:
            return
        code, ids, label, v = _columns(parts, "code", "id", "label", "v")
        codes, ids, label = code.to_numpy(), ids.to_numpy(), label.to_numpy()
        for d, own in _by_length(v):
            x = _matrix(v, own, d)
            order = np.lexsort((ids[own], codes[own]))
            own, x = own[order], x[order]
            for lo, hi in _same(codes[own]):
                self.blocks[int(codes[own[lo]])] = ids[own[lo:hi]], label[own[lo:hi]], x[lo:hi]

    def search(self, asks: pa.RecordBatch, k: int, windows: np.ndarray | None) -> list[list[tuple[np.ndarray, np.ndarray]]]:
        """Per anchor and window (least and largest score; one per anchor column), the k best rows as (ids, scores).
        Without windows: the rows of the anchor's own label, else those of other labels."""
        anchor, label, v = _column(asks, "id").to_numpy(), _column(asks, "label").to_numpy(), _column(asks, "v")
        codes = _column(asks, "codes").to_pylist()
        n_windows = 1 if windows is None else windows.shape[1]
        found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n_windows for _ in range(len(anchor))]
        for d, own in _by_length(v):
            a = _matrix(v, own, d)
            wanted: dict[int, list[int]] = {}
            for i, x in enumerate(own.tolist()):
                for c in codes[x]:
                    wanted.setdefault(c, []).append(i)
            boxes = sorted(wanted)
            low = np.array([self.blocks[c][2].min(axis=0) for c in boxes])
            high = np.array([self.blocks[c][2].max(axis=0) for c in boxes])
            over = bounds(low, high, a)[1]
            for j in np.argsort(-over.max(axis=0), kind="stable").tolist():
                ids, labels, x = self.blocks[boxes[j]]
                # Anchors for which a window is not full yet or the block may still hold a better row.
                who = [i for i in wanted[boxes[j]] if any(len(s) < k or over[i, j] >= s[-1] for _, s in found[own[i]])]
                if not who:
                    continue
                at = own[who]
                scores = products(x, a[who])
                fits = (labels[:, None] == label[at]) if windows is None else (labels[:, None] != label[at])
                fits &= ids[:, None] != anchor[at]
                for w in range(n_windows):
                    inside = fits if windows is None else fits & (scores >= windows[at, w, 0]) & (scores <= windows[at, w, 1])
                    for i, rows in enumerate(first_rows(scores, inside, k)):
                        if len(rows):
                            old = found[at[i]][w]
                            both = np.concatenate([old[0], ids[rows]]), np.concatenate([old[1], scores[rows, i]])
                            top = np.lexsort((both[0], ~both[1]))[:k]
                            found[at[i]][w] = both[0][top], both[1][top]
        return found


def _read(blocks: DataFrame, chosen: DataFrame, n_chunks: int, run: Callable, schema: str) -> DataFrame:
    """Read the chosen blocks of every chunk and let ``run`` answer the anchors that chose them."""
    needed = chosen.select(F.explode("codes").alias("code")).distinct()
    rows = blocks.join(needed, "code", "left_semi").select("chunk", "code", "id", "label", "v")
    return _dealt(rows, chosen, n_chunks, "chunk").mapInArrow(run, schema)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95),
         id_col: str = "vec_id", label_col: str | Column = "label", vector_col: str = "embedding", factor: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score. ``is_anchor`` is a condition on
    the column ``id``; labels are whole numbers; ``window`` is the least and largest percentage of the positive's score."""
    spark = rows.sparkSession
    ship(spark)
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    whole = (rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                         quantised(F.col(vector_col), factor).alias("v"))
             .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()))
    blocks = hilbert_blocks(whole)
    zones = zone_maps(blocks)
    size = zones.agg(F.count("*").alias("zones"), F.max("part").alias("last")).first()
    n_parts = (size["last"] or 0) + 1
    # Parts are joined to chunks where there are more than the rows ask for.
    n_chunks = min(n_parts, max(spark.sparkContext.defaultParallelism, -(-size["zones"] * BLOCK // CHUNK)))
    chunk = F.floor(F.col("part") * n_chunks / n_parts).cast("long")
    blocks, zones = blocks.withColumn("chunk", chunk), zones.withColumn("chunk", chunk).drop("part")
    anchors = stored(first_scores(blocks, is_anchor, positives), "anchors")

    def may_be_positive(part, l0, l1, under, over):
        label = _column(part, "label").to_numpy()[:, None]
        return (l0 <= label) & (label <= l1) & (over >= _column(part, "least").to_numpy()[:, None])

    def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Chunk([])
        for table, asks in _streams(batches, "chunk"):
            if table is not None:
                held = Chunk(table)
                continue
            found = [f[0] for f in held.search(asks, positives, None)]
            n = np.array([len(ids) for ids, _ in found])
            at = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.record_batch([*[_column(asks, c).take(at) for c in ("id", "label", "v")],
                                   pa.array(np.concatenate([ids for ids, _ in found])), pa.array(np.concatenate([s for _, s in found]))],
                                  names=["id", "label", "v", "p", "score"])

    chosen = stored(chosen_blocks(zones, anchors, size["zones"], may_be_positive), "chosen")
    near = _read(blocks, chosen, n_chunks, find_positives, "id long, label long, v array<long>, p long, score long")
    best = Window.partitionBy("id", "label", "v").orderBy(F.desc("score"), "p")
    near = near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives)
    # a * score <= 100 * other <= b * score, in whole numbers and without overflow: q and r are score = 100 * q + r.
    q, r = F.expr("(score - pmod(score, 100)) div 100"), F.pmod("score", F.lit(100))
    low = q * window[0] + F.ceil(r * window[0] / 100).cast("long")
    high = q * window[1] + F.floor(r * window[1] / 100).cast("long")
    windows = near.withColumns({"low": low, "high": high}).where("low <= high")
    asking = stored(windows.groupBy("id", "label", "v").agg(F.array_sort(F.collect_list(F.struct("nth", "p", "score", "low", "high"))).alias("w"))
                    .select("id", "label", "v", *[f"w.{c}" for c in ("p", "score", "low", "high")]), "windows")

    def ranges(part: pa.RecordBatch) -> np.ndarray:
        """Windows of each anchor, padded with empty ones: anchors x positives x (least, largest)."""
        out = np.tile(np.array([1, 0], np.int64), (part.num_rows, positives, 1))
        for c, name in enumerate(("low", "high")):
            for i, values in enumerate(_column(part, name).to_pylist()):
                out[i, :len(values), c] = values
        return out

    def may_be_negative(part, l0, l1, under, over):
        label = _column(part, "label").to_numpy()[:, None]
        w = ranges(part)
        meets = np.zeros(over.shape, bool)
        for i in range(w.shape[1]):
            meets |= (over >= w[:, i, :1]) & (under <= w[:, i, 1:]) & (w[:, i, :1] <= w[:, i, 1:])
        return ((l0 != label) | (l1 != label)) & meets

    def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Chunk([])
        for table, asks in _streams(batches, "chunk"):
            if table is not None:
                held = Chunk(table)
                continue
            found = held.search(asks, negatives, ranges(asks))
            p, s = (_column(asks, c).to_pylist() for c in ("p", "score"))
            out = [(i, w, p[i][w], s[i][w], x, y) for i, f in enumerate(found) for w in range(len(p[i]))
                   for x, y in zip(f[w][0].tolist(), f[w][1].tolist(), strict=True)]
            col = list(zip(*out, strict=True)) or [()] * 6
            at = pa.array(col[0], pa.int64())
            yield pa.record_batch([*[_column(asks, c).take(at) for c in ("id", "label", "v")],
                                   *[pa.array(x, pa.int64()) for x in col[1:]]],
                                  names=["id", "label", "v", "nth", "p", "score", "negative", "other"])

    picked = stored(chosen_blocks(zones, asking, size["zones"], may_be_negative), "picked")
    far = _read(blocks, picked, n_chunks, find_negatives,
                "id long, label long, v array<long>, nth long, p long, score long, negative long, other long")
    order = Window.partitionBy("id", "label", "v", "nth").orderBy(F.desc("other"), "negative")
    return (far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select(F.col("id").alias("anchor_id"), F.col("p").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("negative").alias("negative_id"), F.col("score").alias("positive_score"), F.col("other").alias("negative_score")))
