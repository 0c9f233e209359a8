"""Operator 7: exact n-gram Jaccard join by T-occurrence search (DivideSkip).

A document's set is its distinct 5-word shingles, as 64-bit hashes. Two
documents link when 100 * intersection >= 75 * union; the components of the
links are the result, one row per document.

1. Documents with equal sets are one class; classes, not copies, go on.
2. Shingles are dealt by hash range, many to a row, and counted: only shingles
   of two or more classes can count towards an overlap. Very common ones are
   known beforehand (a bounded list) and are not gathered anywhere.
3. A class of which fewer than the required overlap is shared leaves. The rest
   index their prefix: the n - T + 1 rarest shingles, one of which every partner
   must hold. Classes that share a prefix shingle form candidate components.
4. Within these, blocks of at most ``BLOCK`` classes are searched: per query the
   short inverted lists are merged in a heap and counted, candidates that reach
   T - L are probed in the L longest lists by binary search, and the exact test
   follows.
5. Each block's linked classes go on through one representative, level by level,
   so a huge group of near copies costs in proportion to its size. What is then
   still apart within a candidate component is compared in full, block against
   block; pairs that are already in one component cannot change it and are skipped.

Hashing: an intersection can only be wrong if two shingles of one pair of
documents collide in 64 bits; classes are told apart by 64 bits and their size.

Defined cases: a null text, an empty text or one of separators only has the
empty set, links with nothing and is its own component; repeated rows and ids
are documents of their own (the component id is the smallest id of the linked
rows); null ids are left out of that smallest id, so it is null when no linked
row has one; an empty table gives an empty result; texts are read whole; only
the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm import common
from cartlens.llm.common import parts_for, stored
from cartlens.llm.components import connected, own_key

WORDS, PERCENT = 5, 75
#: Classes in a search block, shingles in a hash range, classes in a bucket.
BLOCK, RANGE, BUCKET = 128, 2_000_000, 20_000
#: Classes with their shingles in a file of intermediate tables.
CLASSES_PER_PART = 5_000
#: The list of very common shingles: its length, and the least share of a pass that names one.
COMMON, COMMON_SHARE = 1 << 18, 64
#: Weight of the long lists in DivideSkip.
MU = 0.0085
PROBES = 1 << 20


def required(n: np.ndarray) -> np.ndarray:
    """Least intersection of a set of n shingles with any partner."""
    return -(-PERCENT * n // 100)


class Sets:
    """The shingle sets of one pass: sorted distinct hashes, one run per row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        rows = len(offsets) - 1
        h, row, _ = common.words(data, offsets)
        token, owner = common.shingles(h, row, WORDS, rows)
        order = np.lexsort((token, owner))
        token, owner = token[order], owner[order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        self.token, self.owner = token[new], owner[new]
        self.n = np.bincount(self.owner, minlength=rows)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(common.mix(self.token))])
        ends = np.cumsum(self.n)
        self.cls = common.mix(sums[ends] - sums[ends - self.n] + self.n.astype(np.uint64)).view(np.int64)

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, class and size per token, each class of the pass once."""
        first = np.zeros(len(self.n), dtype=bool)
        first[np.unique(self.cls, return_index=True)[1]] = True
        keep = first[self.owner]
        return self.token[keep], self.cls[self.owner[keep]], self.n[self.owner[keep]]


def _passes(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Sets]]:
    data, offsets = common.text_column(batch, "text")
    for lo, hi in common.passes(offsets):
        yield lo, hi, Sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])


def document_sets(rows: DataFrame) -> DataFrame:
    """Rows of documents (id, cls, n), and of shingles that many classes of a pass hold (cls: the shingle, common: how many)."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.enter("jaccard_join")
        for b in batches:
            ids = b.column(0)
            for lo, hi, s in _passes(b):
                token, _, _ = s.distinct()
                value, count = np.unique(token, return_counts=True)
                often = count >= max(4, (hi - lo) // COMMON_SHARE)
                k = int(often.sum())
                yield pa.record_batch([
                    pa.concat_arrays([ids.slice(lo, hi - lo), pa.nulls(k, ids.type)]),
                    pa.array(np.concatenate([s.cls, value[often].view(np.int64)])),
                    pa.array(np.concatenate([s.n, np.zeros(k, np.int64)]).astype(np.int64)),
                    pa.array(np.concatenate([np.zeros(hi - lo, np.int64), count[often]]))],
                    names=["id", "cls", "n", "common"])

    return rows.mapInArrow(run, f"id {kind}, cls long, n long, common long")


def _blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _column(t: pa.Table, name: str, dtype: str) -> np.ndarray:
    """The blobs of a column, joined."""
    return np.concatenate([np.frombuffer(x.as_buffer(), dtype=dtype) for c in t.column(name).chunks for x in c] or [np.zeros(0, dtype)])


def _deal(group: np.ndarray, columns: list[tuple[np.ndarray, str]]) -> Iterator[tuple[int, list[bytes]]]:
    """The columns split by group, as blobs."""
    order = np.argsort(group, kind="stable")
    columns = [(c[order], t) for c, t in columns]
    values, start = np.unique(group[order], return_index=True)
    for v, a, b in zip(values.tolist(), start.tolist(), [*start[1:].tolist(), len(group)], strict=True):
        yield v, [_blob(c[a:b].astype(t)) for c, t in columns]


def _batch(rows: list[tuple[int, list[bytes]]], names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([g for g, _ in rows], pa.int32())] +
                           [pa.array([c[i] for _, c in rows], pa.binary()) for i in range(len(names) - 1)], names=names)


def shared_shingles(rows: DataFrame, common_tokens: np.ndarray, n_ranges: int, n_buckets: int) -> DataFrame:
    """Blobs (bucket, cls, n, token, df) of the shingles that two or more classes hold, by class bucket."""
    shipped = rows.sparkSession.sparkContext.broadcast(np.sort(common_tokens))  # at most COMMON hashes

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.enter("jaccard_join")
        names = ["grp", "cls", "n", "token"]
        for b in batches:
            for lo, _, s in _passes(b):
                token, cls, n = s.distinct()
                if not len(token):
                    continue
                group = ((token >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int64)
                known = shipped.value
                if len(known):  # their place in the order is known: spread them by class
                    hot = known[np.minimum(np.searchsorted(known, token), len(known) - 1)] == token
                    group[hot] = (cls[hot].view(np.uint64) % np.uint64(n_ranges)).astype(np.int64)
                yield _batch(list(_deal(group, [(cls, "i8"), (n, "i4"), (token, "u8")])), names)

    def merge(t: pa.Table) -> pa.Table:
        cls, n, token = _column(t, "cls", "i8"), _column(t, "n", "i4"), _column(t, "token", "u8")
        known = shipped.value
        hot = np.zeros(len(token), dtype=bool)
        if len(known):
            hot = known[np.minimum(np.searchsorted(known, token), len(known) - 1)] == token
        value = np.sort(token[~hot])
        twice = np.unique(value[1:][value[1:] == value[:-1]])
        keep = hot.copy()
        if len(twice):
            keep |= ~hot & (twice[np.minimum(np.searchsorted(twice, token), len(twice) - 1)] == token)
        cls, n, token, hot = cls[keep], n[keep], token[keep], hot[keep]
        order = np.lexsort((cls, token))
        cls, n, token, hot = cls[order], n[order], token[order], hot[order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
        cls, n, token, hot = cls[new], n[new], token[new], hot[new]
        _, place, df = np.unique(token, return_inverse=True, return_counts=True)
        df = np.where(hot, np.int64(2**31 - 1), df[place])
        keep = df > 1
        bucket = (cls[keep].view(np.uint64) % np.uint64(n_buckets)).astype(np.int64)
        out = _deal(bucket, [(cls[keep], "i8"), (n[keep], "i4"), (token[keep], "u8"), (df[keep], "i4")])
        return pa.Table.from_batches([_batch(list(out), ["bucket", "cls", "n", "token", "df"])])

    return (rows.mapInArrow(split, "grp int, cls binary, n binary, token binary")
            .groupBy("grp").applyInArrow(merge, "bucket int, cls binary, n binary, token binary, df binary"))


def survivors(shared: DataFrame) -> DataFrame:
    """Classes that can have a partner: cls, n, tokens (their shared shingles, rarest first) and prefix."""

    def gather(t: pa.Table) -> pa.Table:
        cls, n, token, df = _column(t, "cls", "i8"), _column(t, "n", "i4"), _column(t, "token", "u8"), _column(t, "df", "i4")
        order = np.lexsort((token, df, cls))
        cls, n, token = cls[order], n[order].astype(np.int64), token[order]
        new = np.ones(len(cls), dtype=bool)
        new[1:] = (cls[1:] != cls[:-1]) | (token[1:] != token[:-1])  # a common shingle comes once per copy
        cls, n, token = cls[new], n[new], token[new]
        head = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]])) if len(cls) else np.zeros(0, np.int64)
        held = np.diff(np.append(head, len(cls)))
        n = n[head]
        need = required(n)
        stays = held >= need
        # Of the n - need + 1 rarest shingles, those that no other class holds come first.
        prefix = (n - need + 1) - (n - held)
        rows = np.flatnonzero(stays)
        take = np.repeat(head[rows], prefix[rows]) + np.arange(prefix[rows].sum()) - np.repeat(np.cumsum(prefix[rows]) - prefix[rows], prefix[rows])
        return pa.table([pa.array(cls[head[rows]]), pa.array(n[rows]),
                         pa.array([_blob(token[head[r]:head[r] + held[r]]) for r in rows.tolist()], pa.binary()),
                         pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(prefix[rows])]), pa.int32()),
                                                  pa.array(token[take].view(np.int64)))],
                        names=["cls", "n", "tokens", "prefix"])

    return shared.groupBy("bucket").applyInArrow(gather, "cls long, n long, tokens binary, prefix array<long>")


class Index:
    """Inverted lists of one block's classes (in ascending size)."""

    def __init__(self, cls: np.ndarray, n: np.ndarray, tokens: list[np.ndarray]):
        self.cls, self.n, self.size = cls, n, len(cls)
        owner = np.repeat(np.arange(self.size), [len(t) for t in tokens])
        _, flat, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        keep = count[flat] > 1
        flat, owner = flat[keep], owner[keep]
        self.lists = [flat[a:b] for a, b in zip(*(lambda e: (e[:-1], e[1:]))(np.searchsorted(owner, np.arange(self.size + 1))), strict=True)]
        self.postings = np.sort(flat * self.size + owner)  # (list, class), in order
        self.start = np.searchsorted(self.postings, np.arange(len(count) + 1) * self.size)
        self.length = np.diff(self.start)

    def partners(self, q: int, wanted: np.ndarray) -> np.ndarray:
        """The later classes, of those ``wanted``, that link with class q."""
        need = int(required(self.n[q:q + 1])[0])
        lists = self.lists[q]
        if len(lists) < need:
            return np.zeros(0, np.int64)
        lists = lists[np.argsort(-self.length[lists], kind="stable")]
        longest = int(self.length[lists[0]])
        n_long = min(need - 1, int(need / (MU * np.log2(longest) + 1)))
        long, short = lists[:n_long], lists[n_long:]
        size = self.length[short]
        at = np.repeat(self.start[short] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        found = self.postings[at] % self.size
        keep = wanted[found]
        found, of = found[keep], np.repeat(np.arange(len(short)), size)[keep]
        if not len(found):
            return found
        # The short lists, each ascending, meet in a heap; equal classes come out together.
        runs = [r.tolist() for r in np.split(found, np.flatnonzero(np.diff(of)) + 1)]
        met = [(c, sum(1 for _ in same)) for c, same in itertools.groupby(heapq.merge(*runs))]
        candidate, count = np.array(met, dtype=np.int64).T
        # A class of m shingles must share ceil(75 (n + m) / 175) of them.
        least = -(-PERCENT * (self.n[q] + self.n[candidate]) // (100 + PERCENT))
        keep = count + n_long >= least
        candidate, count = candidate[keep], count[keep]
        step = max(1, PROBES // max(1, n_long))
        for lo in range(0, len(candidate) if n_long else 0, step):
            part = candidate[lo:lo + step]
            key = (long[:, None] * self.size + part).ravel()
            hit = self.postings[np.minimum(np.searchsorted(self.postings, key), len(self.postings) - 1)] == key
            count[lo:lo + step] += hit.reshape(n_long, len(part)).sum(axis=0)
        union = self.n[q] + self.n[candidate] - count
        return candidate[100 * count >= PERCENT * union]


def search(cls: np.ndarray, n: np.ndarray, tokens: list[np.ndarray], part: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Component label of each class. Pairs of one ``joined`` label, and pairs in
    which neither class has ``part`` 1, are not looked at."""
    order = np.lexsort((cls, n))
    index = Index(cls[order], n[order], [tokens[i] for i in order])
    part = part[order]
    _, label = np.unique(joined[order], return_inverse=True)
    later = np.arange(len(cls))
    for q in range(len(cls) - 1):
        wanted = (later > q) & (label != label[q])
        if not part[q]:
            wanted &= part == 1
        if not wanted.any():
            continue
        for c in index.partners(q, wanted).tolist():
            if label[c] != label[q]:
                label[label == label[c]] = label[q]
    out = np.empty(len(cls), np.int64)
    out[order] = label
    return out


def link(blocks: DataFrame) -> DataFrame:
    """Edges (u, v) from each class to the first of its component within its block.
    ``blocks`` holds the block's keys and cls, n, tokens, part and joined."""

    def run(t: pa.Table) -> pa.Table:
        cls, n = t.column("cls").to_numpy(), t.column("n").to_numpy()
        tokens = [np.frombuffer(x, dtype=np.uint64) for x in t.column("tokens").to_pylist()]
        label = search(cls, n, tokens, t.column("part").to_numpy(), t.column("joined").to_numpy())
        order = np.lexsort((cls, n, label))
        first = np.concatenate([[True], label[order][1:] != label[order][:-1]])
        head = order[first][np.cumsum(first) - 1]
        return pa.table([pa.array(cls[order]), pa.array(cls[head])], names=["u", "v"])

    return blocks.groupBy("root", "i", "j").applyInArrow(run, "u long, v long")


def _sized(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of blocks of their candidate component ``root``."""
    sizes = rows.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))
    sizes = sizes.select(own_key("root").alias("owner"), "n_blocks")
    return rows.join(sizes, own_key("root") == F.col("owner")).drop("owner")


def _link_blocks(rows: DataFrame, level: int, parts: int) -> DataFrame:
    """One search per block of each candidate component: its edges, and whether the component has other blocks."""
    block = F.pmod(F.xxhash64("cls", F.lit(level)), F.col("n_blocks")).cast("int")
    blocks = rows.select("root", block.alias("i"), F.when(F.col("n_blocks") > 1, 1).otherwise(0).alias("j"), "cls", "n", "tokens",
                         F.lit(1).alias("part"), F.col("cls").alias("joined"))
    return stored(link(blocks), "links", parts)


def verified(kept: DataFrame, candidates: DataFrame) -> DataFrame:
    """(node, root) of the classes that are linked with a smaller or earlier one."""
    rows = kept.select("cls", "n", "tokens").join(candidates.select(F.col("u").alias("cls"), "root"), "cls")
    rows = stored(rows, "classes")
    parts = parts_for(rows.sparkSession, rows.count(), CLASSES_PER_PART)
    rows = stored(_sized(rows), "sized-classes", parts)
    found = _link_blocks(rows, 0, parts)
    large = rows.where("n_blocks > 1")
    edges = found.select(F.col("u").alias("node"), F.col("v").alias("root")).where("node <> root")
    if large.isEmpty():
        return edges  # every component was searched whole: the edges lead straight to one class of each
    # Components of several blocks: link the blocks' representatives, level by level.
    mine = found.join(large.select(F.col("cls").alias("u")), "u", "left_semi")
    links, now, level, before = mine, large, 0, None
    while True:
        heads = mine.select(F.col("v").alias("cls")).distinct()
        now = stored(_sized(now.where("n_blocks > 1").drop("n_blocks").join(heads, "cls", "left_semi")), "heads", parts)
        left, level = now.count(), level + 1
        if not left or (before is not None and left > before / 2):
            break  # few of the rest link: what is left is compared below
        before = left
        mine = _link_blocks(now, level, parts)
        links = links.unionAll(mine)
    # What is still apart: compare everything outside a component's largest part with all of it.
    joined = connected(links)
    apart = large.drop("n_blocks").join(joined.select(F.col("node").alias("cls"), F.col("root").alias("joined")), "cls", "left")
    apart = stored(apart.withColumn("joined", F.coalesce("joined", "cls")), "parts", parts)
    size = apart.groupBy("root", "joined").agg(F.count("*").alias("size"))
    main = size.groupBy("root").agg(F.max(F.struct("size", "joined")).alias("most"), F.sum("size").alias("all"))
    main = (main.where(F.col("most.size") < F.col("all"))
            .select(own_key("root").alias("owner"), F.col("most.joined").alias("main"),
                    F.ceil((F.col("all") - F.col("most.size")) / BLOCK).cast("int").alias("n_rest"),
                    F.ceil(F.col("all") / BLOCK).cast("int").alias("n_all")))
    apart = apart.join(main, own_key("root") == F.col("owner")).withColumn("rest", F.col("joined") != F.col("main"))
    of_rest = F.pmod(F.xxhash64("cls"), F.col("n_rest")).cast("int")
    of_all = F.pmod(F.xxhash64("cls", F.lit(1)), F.col("n_all")).cast("int")
    one = apart.where("rest").select("root", of_rest.alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)).alias("j"),
                                     "cls", "n", "tokens", F.lit(1).alias("part"), "joined")
    # A class on both sides of a block comes once, on the rest's side.
    other = apart.select("root", F.explode(F.sequence(F.lit(0), F.col("n_rest") - 1)).alias("i"), of_all.alias("j"),
                         "cls", "n", "tokens", F.lit(0).alias("part"), "joined", "rest", of_rest.alias("mine"))
    other = other.where(~(F.col("rest") & (F.col("mine") == F.col("i")))).drop("rest", "mine")
    whole = connected(links.unionAll(link(one.unionAll(other))))
    return edges.join(large.select(F.col("cls").alias("node")), "node", "left_anti").unionAll(whole)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles and component_id of every row."""
    spark = docs.sparkSession
    common.ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    both = stored(document_sets(rows), "sets")
    sets = both.where("common = 0").select("id", "cls", "n")
    total, size = both.agg(F.sum("n"), F.count("*")).first()
    often = both.where("common > 0").groupBy("cls").agg(F.sum("common").alias("c"))
    often = often.where(F.col("c") >= max(64, size // 512)).orderBy(F.desc("c"), "cls").limit(COMMON)
    tokens = np.array([r["cls"] for r in often.select("cls").collect()], dtype=np.int64).view(np.uint64)
    least = spark.sparkContext.defaultParallelism
    n_ranges = max(4 * least, -(-(total or 0) // RANGE))
    kept = stored(survivors(shared_shingles(rows, tokens, n_ranges, max(least, -(-size // BUCKET)))), "survivors")
    postings = kept.select(F.explode("prefix").alias("token"), "cls")
    first = postings.groupBy("token").agg(F.min("cls").alias("v"), F.max("cls").alias("w")).where("v < w").select(own_key("token").alias("t"), "v")
    lists = postings.join(first, own_key("token") == F.col("t")).select(F.col("cls").alias("u"), "v")
    candidates = connected(lists)
    roots = candidates.select("root").distinct()
    candidates = candidates.select(F.col("node").alias("u"), "root").unionAll(roots.select(F.col("root").alias("u"), "root"))
    parts = verified(kept, candidates).select(F.col("node").alias("cls"), "root")
    named = stored(sets.join(parts, "cls", "left").select("id", "n", F.coalesce("root", "cls").alias("root")), "named")
    smallest = named.where("n > 0").groupBy("root").agg(F.min("id").alias("component_id")).select(own_key("root").alias("r"), "component_id")
    return (named.join(smallest, own_key("root") == F.col("r"), "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest id (then of the smallest
    digest of id and text). Rows that repeat id and text are one document; documents without
    words stay. All columns are kept."""
    names = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("\0null")), text)))
    own = docs.select(F.struct(F.col(id_col).alias("id"), key.alias("key")).alias("row"), F.col(text_col).alias("text"))
    parts = join(own, "row", "text").where((F.col("n_shingles") == 0) | (F.col("row") == F.col("component_id")))
    kept = stored(parts.select(F.col("row.key").alias("kept")).distinct(), "kept")
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], key.alias("key"))
    rows = rows.join(kept, F.col("key") == F.col("kept"), "left_semi").dropDuplicates(["key"])
    return rows.drop("key").toDF(*names)
