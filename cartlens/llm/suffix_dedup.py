"""Operator 4: exact removal of repeated byte strings by suffix sorting.

Each byte covered by a ``LENGTH``-byte string that also starts anywhere else, in
another document or the same one, is removed. Strings never cross documents and
are judged on the input. With ``words`` the strings are those from the first byte
of a word to the last byte of the ``words``-th (:func:`cartlens.llm.common.tokens`;
occurrences begin and end at words and agree in all bytes between); a text is then a
sequence of 64-bit hashes, of its words and of the bytes between them in turn, and
for "byte" read "hash" below.

1. Every string of ``LENGTH`` bytes is represented by its anchor, the smallest
   hash of its ``GRAM``-byte substrings. Equal strings have equal anchors, and
   consecutive starts with one anchor (at one place) form a window, so a document is a sequence
   of windows. Anchors that occur once are dropped.
2. Equal windows are one, with their number; of each, one document hands out the
   bytes. Windows are dealt to shards by anchor, so all occurrences of a string
   meet in one shard. An anchor whose windows are all equal is settled by that.
3. A shard's windows are joined with separators and suffix-sorted by external
   induced sorting (:mod:`cartlens.llm.induced_sort`): bucket queues (in memory, as
   shards are small), recursion on the reduced text. Neighbours in suffix order with a common prefix
   of ``LENGTH`` bytes are repeats (the common prefix is tested by prefix hashes,
   as only "at least LENGTH" counts).
4. An anchor with more than ``HOT`` different windows does not go to one task:
   its windows are cut again by a second anchor, equal parts are settled by their
   number, and the strings of the others are counted one by one, by two 64-bit
   hashes, in an aggregate that reduces before the shuffle and a join that
   adaptive execution may split.
5. Marked starts go back to all occurrences, and every document is cut.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` bytes are
never cut (but nothing else can contain them either); equal rows (id and text)
count as different documents, so their long texts are removed in each; null ids
are an id like any other; an empty table gives an empty result; texts are read
whole; carried columns travel under positional names, so no name clashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.llm import common
from cartlens.llm.common import stored
from cartlens.llm.induced_sort import suffix_array

LENGTH, GRAM = 400, 128
#: Words of a passage that the registered query reports beside the strings it removes.
PASSAGE = 51
#: Bytes hashed by one numpy pass: few enough to stay in a processor's cache.
PASS = 32_768
#: Bytes of windows in a shard on average, and windows of one anchor that a shard takes.
SHARD, HOT = 2_000_000, 1_000


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` consecutive ones."""
    n = len(h)
    padded = np.concatenate([h, np.full(-n % width, np.uint64(2**64 - 1))]).reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each row's words and of the bytes after each, in turn; n+1 offsets of the rows in
    them; first byte and end of each word."""
    s, e, row = common.tokens(data, offsets)
    sums = common.prefix_hash(data)
    out = np.empty(2 * len(s), dtype=np.uint64)
    out[::2] = common.span_hash(sums, s, e)
    out[1::2] = common.span_hash(sums, e, np.minimum(np.append(s[1:], len(data)), offsets[row + 1])[:len(s)])
    return out, 2 * np.searchsorted(row, np.arange(len(offsets))), s, e


def _sums(data: np.ndarray) -> np.ndarray:
    """Karp-Rabin prefix sums of bytes or of 64-bit hashes."""
    if data.dtype == np.uint8:
        return common.prefix_hash(data)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data * common.powers(len(data))[0][:len(data)], out=out[1:])
    return out


def windows(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Row, first start, number of starts, anchor and content hash of every window of a pass."""
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    sums = _sums(data)
    h = (sums[gram:] - sums[:-gram]) * common.powers(len(data))[1][:len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    low = _sliding_min(h, length - gram + 1)
    new = np.ones(len(low), dtype=bool)
    new[1:] = low[1:] != low[:-1]
    new[1:] |= h[:len(low) - 1] == low[:-1]  # the anchor (the leftmost smallest) stood at the start itself and is left behind
    inside = np.zeros(len(low) + length, dtype=bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= length:
            inside[a:b - length + 1] = new[a] = True
    inside = inside[:len(low)]
    first = np.flatnonzero(new & inside)
    row = np.searchsorted(offsets, first, side="right") - 1
    end = np.minimum(np.append(first[1:], len(low)), offsets[row + 1] - length + 1)
    content = common.span_hash(sums, first, end + length - 1) + common.mix((end - first).astype(np.uint64))
    return row, first - offsets[row], end - first, low[first], content


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _key(id_col: str, text: Column) -> Column:
    """128 bits that tell rows of different id or text apart."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("\0null")), text)))


def find_windows(rows: DataFrame, length: int, gram: int, words: bool = False) -> DataFrame:
    """All windows of (key, text) rows: key, first, starts, anchor, content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.enter("suffix_dedup")
        for b in batches:
            data, offsets = common.text_column(b, "text")
            found = []
            for lo, hi in common.passes(offsets, PASS):
                part, own = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                if words:
                    part, own, *_ = symbols(part, own)
                row, *rest = windows(part, own, length, gram)
                found.append((row + lo, *rest))
            if found:
                row, first, count, anchor, content = map(np.concatenate, zip(*found, strict=True))
                yield pa.record_batch([b.column(0).take(pa.array(row)), pa.array(first), pa.array(count),
                                       _signed(anchor), _signed(content)],
                                      names=["key", "first", "starts", "anchor", "content"])

    return rows.mapInArrow(run, "key binary, first long, starts long, anchor long, content long")


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]])))
    return edge[::2], edge[1::2]


def sort_shard(texts: list[bytes], starts: np.ndarray, several: np.ndarray, length: int, dtype=np.uint8) -> list[np.ndarray]:
    """For each window of a shard, flags of the starts whose string occurs again."""
    gap = bytes(np.dtype(dtype).itemsize)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) // len(gap)
    data = np.frombuffer(gap.join(texts) + gap, dtype=dtype)
    ends = np.cumsum(sizes + 1) - 1
    n_symbols = 256
    if dtype == np.uint8:
        x = data.astype(np.int32) + len(texts)
    else:
        known, x = np.unique(data, return_inverse=True)
        n_symbols, x = len(known), x.astype(np.int32) + len(texts)
    x[ends] = np.arange(len(texts))[::-1]  # separators differ, the last one is the smallest
    begin = ends - sizes
    is_start = np.zeros(len(x) + 1, dtype=np.int32)
    np.add.at(is_start, begin, 1)
    np.add.at(is_start, begin + starts, -1)
    order = suffix_array(x, len(texts) + n_symbols)
    order = order[(np.cumsum(is_start)[:-1] > 0)[order]]
    sums = _sums(data)
    code = common.span_hash(sums, order, order + length)
    same = code[1:] == code[:-1]
    marked = np.zeros(len(x), dtype=bool)
    marked[order[1:][same]] = marked[order[:-1][same]] = True
    return [marked[b:b + s] if not m else np.ones(s, dtype=bool)
            for b, s, m in zip(begin.tolist(), starts.tolist(), several.tolist(), strict=True)]


MARKS = "anchor long, content long, spans binary"


def _marks(anchor: list, content: list, flags: list[np.ndarray]) -> pa.RecordBatch:
    gap = np.zeros(1, dtype=bool)  # ends a run at the end of its window
    a, b = _runs(np.concatenate([gap] + [x for f in flags for x in (f, gap)]))
    begin = np.cumsum([1] + [len(f) + 1 for f in flags])
    cut = np.searchsorted(a, begin)
    row = np.repeat(begin[:-1], np.diff(cut))
    pairs = np.stack([a - row, b - row], axis=1).astype(np.int64)
    keep = np.flatnonzero(np.diff(cut)).tolist()
    return pa.record_batch([pa.array([anchor[i] for i in keep], pa.int64()), pa.array([content[i] for i in keep], pa.int64()),
                            pa.array([pairs[cut[i]:cut[i + 1]].tobytes() for i in keep], pa.binary())],
                           names=["anchor", "content", "spans"])


def _cold(chosen: DataFrame, n_shards: int, length: int, dtype=np.uint8) -> DataFrame:
    def run(t: pa.Table) -> pa.Table:
        common.enter("suffix_dedup")
        _, first = np.unique(np.stack([t.column(c).to_numpy() for c in ("anchor", "content")]), axis=1, return_index=True)
        t = t.take(pa.array(first))
        anchor, content, texts = (t.column(c).to_pylist() for c in ("anchor", "content", "bytes"))
        starts, several = t.column("starts").to_numpy(), t.column("n").to_numpy() > 1
        return pa.Table.from_batches([_marks(anchor, content, sort_shard(texts, starts, several, length, dtype))])

    shard = F.pmod(F.xxhash64("anchor"), F.lit(n_shards))
    return chosen.withColumn("shard", shard).groupBy("shard").applyInArrow(run, MARKS)


SUB = ("anchor long, content long, n long, first long, starts long, inner long, bytes_hash long, "
       "one array<long>, two array<long>")


def _hot(chosen: DataFrame, length: int, gram: int, dtype=np.uint8) -> DataFrame:
    """The same marks for anchors with very many windows. Their windows are cut again by a second,
    shorter anchor; equal parts are settled by their number, and only the strings of the
    others are counted one by one."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.enter("suffix_dedup")
        for b in batches:
            for i, text in enumerate(b.column("bytes").to_pylist()):
                data = np.frombuffer(text, dtype=dtype)
                forward, backward = _sums(data), _sums(data[::-1].copy())
                _, first, starts, inner, content = windows(data, np.array([0, len(data)]), length, min(length, max(8, gram // 4)))
                at = np.arange(starts.sum())
                ends = np.concatenate([[0], np.cumsum(starts)]).astype(np.int32)
                hashes = [common.span_hash(forward, at, at + length),
                          common.span_hash(backward, len(data) - at - length, len(data) - at)]
                yield pa.record_batch(
                    [pa.array([b.column(c)[i].as_py()] * len(first), pa.int64()) for c in ("anchor", "content", "n")] +
                    [pa.array(first), pa.array(starts), _signed(inner), _signed(content)] +
                    [pa.ListArray.from_arrays(pa.array(ends), _signed(h)) for h in hashes],
                    names=[f.split()[0] for f in SUB.split(", ")])

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flags = []
            for whole, at in zip(b.column("whole").to_pylist(), b.column("at").to_pylist(), strict=True):
                f = np.zeros(max([x["first"] + x["starts"] for x in whole] + [x + 1 for x in at]), dtype=bool)
                f[at] = True
                for x in whole:
                    f[x["first"]:x["first"] + x["starts"]] = True
                flags.append(f)
            yield _marks(b.column("anchor").to_pylist(), b.column("content").to_pylist(), flags)

    parts = stored(chosen.dropDuplicates(["anchor", "content"]).mapInArrow(split, SUB), "hot-parts")
    # Parts of equal bytes: how many there are, and (first) one of them to stand for all.
    same = parts.groupBy("inner", "bytes_hash").agg(F.sum("n").alias("times"), F.min(F.struct("anchor", "content", "first")).alias("head"))
    same = stored(same, "hot-same").select(F.col("inner").alias("i"), F.col("bytes_hash").alias("h"), "times", "head")
    parts = stored(parts.join(same, (F.col("inner") == F.col("i")) & (F.col("bytes_hash") == F.col("h"))).drop("i", "h"), "hot-counted")
    whole = parts.where("times > 1").select("anchor", "content", F.struct("first", "starts").alias("piece"))
    heads = parts.where(F.struct("anchor", "content", "first") == F.col("head"))
    pair = F.inline(F.arrays_zip(F.transform("one", lambda x, i: i).alias("k"), "one", "two"))
    each = heads.select("anchor", "content", "first", "times", pair)
    counts = stored(each.groupBy("one", "two").agg(F.sum("times").alias("sum")).where("sum > 1").select("one", "two"), "hot-counts")
    again = each.where("times = 1").join(counts, ["one", "two"]).select("anchor", "content", (F.col("first") + F.col("k")).alias("start"))
    both = (whole.select("anchor", "content", "piece", F.lit(None).cast("long").alias("start"))
            .unionAll(again.select("anchor", "content", F.lit(None).cast("struct<first:bigint,starts:bigint>"), "start")))
    return (both.groupBy("anchor", "content").agg(F.collect_list("piece").alias("whole"), F.collect_list("start").alias("at"))
            .mapInArrow(spans, MARKS))


def repeats(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, words: bool = False) -> DataFrame:
    """Covered stretches of (key, text) rows: key and pieces, an array of (first, spans) where
    spans holds pairs of 64-bit offsets from ``first``: the marked starts. With ``words`` all
    of them, the length and the gram count entries of :func:`symbols`."""
    dtype = np.uint64 if words else np.uint8
    least = rows.sparkSession.sparkContext.defaultParallelism
    found = stored(find_windows(rows, length, gram, words), "windows")
    often = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("content").alias("a"), F.max("content").alias("b"))
    often = stored(often.where("n > 1").select(F.col("anchor").alias("held"), (F.col("a") == F.col("b")).alias("equal")), "anchors")
    found = stored(found.join(often, F.col("anchor") == F.col("held")).drop("held"), "repeated-anchors")
    # Where all windows of an anchor are equal, every start is a repeat: nothing is left to sort.
    equal, found = found.where("equal"), found.where("not equal")
    distinct = found.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "first", "starts")).alias("at"))
    distinct = stored(distinct.select("anchor", "content", "n", "at.key", "at.first", "at.starts"), "distinct-windows")
    hot = stored(distinct.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select(F.col("anchor").alias("held")), "hot")
    size = (distinct.agg(F.sum(F.col("starts") + length)).first()[0] or 0) * np.dtype(dtype).itemsize
    wanted = distinct.groupBy("key").agg(F.collect_list(F.struct("anchor", "content", "n", "first", "starts")).alias("w"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.enter("suffix_dedup")
        for b in batches:
            data, offsets = common.text_column(b, "text")
            if words:
                parts = [symbols(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])[:2] for lo, hi in common.passes(offsets)]
                sizes = [np.diff(own) for _, own in parts]
                data = np.concatenate([np.zeros(0, dtype)] + [part for part, _ in parts])
                offsets = np.cumsum(np.concatenate([np.zeros(1, np.int64)] + sizes))
            w = b.column("w")
            row = np.repeat(np.arange(b.num_rows), w.value_lengths().to_numpy(zero_copy_only=False))
            flat = w.flatten()
            first, starts = flat.field("first").to_numpy(), flat.field("starts").to_numpy()
            begin = offsets[row] + first
            end = begin + starts + length - 1
            yield pa.record_batch([flat.field("anchor"), flat.field("content"), flat.field("n"), flat.field("starts"),
                                   pa.array([data[a:z].tobytes() for a, z in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())],
                                  names=["anchor", "content", "n", "starts", "bytes"])

    holders = rows.dropDuplicates(["key"]).join(wanted.withColumnRenamed("key", "of"), F.col("key") == F.col("of")).select("text", "w")
    chosen = holders.mapInArrow(cut, "anchor long, content long, n long, starts long, bytes binary")
    if hot.isEmpty():
        marks = _cold(chosen, max(4 * least, -(-size // SHARD)), length, dtype)
    else:
        chosen = stored(chosen, "window-bytes")
        is_hot = F.col("anchor") == F.col("held")
        marks = (_cold(chosen.join(hot, is_hot, "left_anti"), max(4 * least, -(-size // SHARD)), length, dtype)
                 .unionAll(_hot(chosen.join(hot, is_hot, "left_semi"), length, gram, dtype)))
    marks = stored(marks, "marks").select(F.col("anchor").alias("a"), F.col("content").alias("c"), "spans")
    pieces = found.join(marks, (F.col("anchor") == F.col("a")) & (F.col("content") == F.col("c")))
    pieces = pieces.select("key", "first", "starts", "spans").unionAll(
        equal.select("key", "first", "starts", F.lit(None).cast("binary").alias("spans")))
    return stored(pieces.groupBy("key").agg(F.collect_set(F.struct("first", "starts", "spans")).alias("pieces"))
                  .withColumnRenamed("key", "of"), "pieces")


def _pairs(spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of 64-bit numbers of a column of spans, and how many each entry holds (a null: none)."""
    if spans.null_count == len(spans):
        return np.zeros((0, 2), np.int64), np.zeros(len(spans), np.int64)
    spans = spans.fill_null(b"").cast(pa.large_binary())
    ends = np.frombuffer(spans.buffers()[1], dtype=np.int64)[spans.offset:spans.offset + len(spans) + 1]
    raw = np.frombuffer(spans.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]
    return raw.view(np.int64).reshape(-1, 2), np.diff(ends) // 16


def _cuts(pieces: pa.Array, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end (in bytes of the batch) of the covered stretches, by row."""
    counts = np.asarray(pieces.value_lengths().fill_null(0))
    flat = pieces.flatten()
    row = np.repeat(np.arange(len(pieces)), counts)
    begin = offsets[row] + flat.field("first").to_numpy(zero_copy_only=False)
    spans = flat.field("spans")
    whole = np.asarray(spans.is_null())
    pairs, sizes = _pairs(spans)
    at = np.repeat(begin, sizes)
    rows = np.concatenate([row[whole], np.repeat(row, sizes)])
    begins = np.concatenate([begin[whole], pairs[:, 0] + at])
    ends = np.concatenate([(begin + flat.field("starts").to_numpy(zero_copy_only=False))[whole], pairs[:, 1] + at]) + length - 1
    order = np.argsort(rows, kind="stable")
    return rows[order], begins[order], ends[order]


def _covered(data: np.ndarray, offsets: np.ndarray, rows: tuple[int, int], cuts: tuple[np.ndarray, ...], words: int | None) -> np.ndarray:
    """Flags of the bytes of a pass (from row ``lo`` up to ``hi``) that the stretches of :func:`_cuts`
    cover; with ``words`` those are marked starts and their ends, in entries of :func:`symbols`."""
    lo, hi = rows
    base, size = offsets[lo], int(offsets[hi] - offsets[lo])
    row, begin, end = cuts
    i, j = np.searchsorted(row, [lo, hi])
    row, begin, end = row[i:j] - lo, begin[i:j], end[i:j]
    if words and i < j:  # of the marked starts, those at words count; only texts with marks are read
        held, nth = np.unique(row, return_inverse=True)
        texts = [data[offsets[r]:offsets[r + 1]] for r in (held + lo).tolist()]
        own = np.cumsum([0] + [len(t) for t in texts])
        s, e, of = common.tokens(np.concatenate(texts), own)
        word = np.searchsorted(of, np.arange(len(held)))[nth]
        a, z = word + (begin + 1) // 2, word + (end - (2 * words - 1)) // 2
        at_word = a <= z
        shift = (offsets[held + lo] - base - own[:-1])[nth][at_word]
        begin, end = s[a[at_word]] + shift, e[z[at_word] + words - 1] + shift
    else:
        begin, end = begin - base, end - base
    return np.cumsum(np.bincount(begin, minlength=size + 1)[:size] - np.bincount(end, minlength=size + 1)[:size]) > 0


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] | None = None,
          length: int = LENGTH, with_text: bool = False, gram: int = GRAM, words: int | None = None, passages: int | None = None) -> DataFrame:
    """The carried columns (as ``c0``, ``c1``, ...; by default the id), n_bytes, n_removed, n_spans and
    kept_sha256 of every row; with ``with_text`` also the kept bytes as text (broken characters dropped).
    With ``words`` strings of so many words are removed, in place of ``length`` bytes. With ``passages``
    two more columns tell what strings of so many words that occur again cover, of the text as it was:
    n_passages (maximal runs) and passage_bytes; nothing is removed for them."""
    if words:
        length = 2 * words - 1
        gram = max(1, length // 3)
    common.ship(docs.sparkSession)
    carry = (id_col,) if carry is None else carry
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(_key(id_col, text).alias("key"), text.alias("text"))
    pieces = repeats(rows, length, gram, bool(words))
    if passages:
        span = 2 * passages - 1
        again = repeats(rows, span, max(1, span // 3), True).select(F.col("of").alias("same"), F.col("pieces").alias("passages"))
        pieces = pieces.join(again, F.col("of") == F.col("same"), "full").select(
            F.coalesce("of", "same").alias("of"), "pieces", "passages")
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)] + [_key(id_col, text).alias("key")]
    inside = text_col in carry  # then the text travels once
    full = docs.select(*carried) if inside else docs.select(*carried, text.alias("text"))
    name = f"c{carry.index(text_col)}" if inside else "text"
    columns = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["n_passages", "passage_bytes"] * bool(passages) + ["kept"] * with_text
    kinds = {"kept_sha256": "string", "kept": "string"}
    schema = ", ".join([f"c{i} {t}" for i, (_, t) in enumerate(full.dtypes[:len(carry)])] + [f"{c} {kinds.get(c, 'long')}" for c in columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.enter("suffix_dedup")
        for b in batches:
            data, offsets = common.text_column(b, name)
            cuts = _cuts(b.column("pieces"), np.zeros_like(offsets) if words else offsets, length)
            marks = _cuts(b.column("passages"), np.zeros_like(offsets), 2 * passages - 1) if passages else None
            out = {c: [] for c in columns}
            out["n_bytes"] = np.diff(offsets)
            for lo, hi in common.passes(offsets):
                base = offsets[lo]
                gone = _covered(data, offsets, (lo, hi), cuts, words)
                touched = set(cuts[0][slice(*np.searchsorted(cuts[0], [lo, hi]))].tolist())
                if passages:
                    again = _covered(data, offsets, (lo, hi), marks, passages)
                    found = set(marks[0][slice(*np.searchsorted(marks[0], [lo, hi]))].tolist())
                for r in range(lo, hi):
                    a, z = int(offsets[r] - base), int(offsets[r + 1] - base)
                    raw = data[offsets[r]:offsets[r + 1]]
                    left = (raw[~gone[a:z]] if r in touched else raw).tobytes()
                    out["n_removed"].append(len(raw) - len(left))
                    out["n_spans"].append(len(_runs(gone[a:z])[0]) if r in touched else 0)
                    out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                    if passages:
                        out["n_passages"].append(len(_runs(again[a:z])[0]) if r in found else 0)
                        out["passage_bytes"].append(int(again[a:z].sum()) if r in found else 0)
                    if with_text:
                        out["kept"].append(left.decode("utf-8", "ignore"))
            cols = [pa.array(out[c], pa.string() if c in kinds else pa.int64()) for c in columns]
            yield pa.record_batch(b.columns[:len(carry)] + cols, names=[f"c{i}" for i in range(len(carry))] + columns)

    return full.join(pieces, F.col("key") == F.col("of"), "left").drop("key", "of").mapInArrow(run, schema)
