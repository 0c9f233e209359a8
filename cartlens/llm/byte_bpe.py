"""Operator 5: byte-level BPE encoding and decoding.

A text is split by the tokenizer's pattern; the distinct pieces of a batch are
laid out as padded numpy matrices of byte ids, one per length bucket. Each
round every row merges its leftmost pair of minimum rank: ranks come from a
hashed table of all mergeable pairs, and the row is compacted by one column.
A row without a mergeable pair is finished and leaves the matrix. Pieces longer
than ``MATRIX_BYTES`` are merged in the same order with a heap instead, since
compacting such a row each round would cost the square of its length.

Defined cases: a null text is empty; an empty text has no ids (digests of the
empty string); null or repeated ids: each row is encoded for itself; empty
table: empty result; texts of any length are encoded whole; only the named
columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import enter, keep_cache, ship

#: Longest piece laid out in a matrix.
MATRIX_BYTES = 256
#: Pieces whose ids are remembered by a worker, and the cells of one matrix.
CACHE_PIECES, MATRIX_CELLS = 300_000, 1 << 18
#: Characters of text encoded together (or one longer text).
GROUP_CHARS = 400_000
_NONE = np.int32(2**31 - 1)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a rank file: a base64 token and its rank per line."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


class PairTable:
    """Open-addressed hash table from a pair of ids to the id of their merge."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, vals = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    vals.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.vals = np.full(1 << self.bits, _NONE)
        left, vals = np.array(keys, dtype=np.uint64), np.array(vals, dtype=np.int32)
        at = self._home(left)
        self.probes = 0
        while len(left):
            self.probes += 1
            _, first = np.unique(at, return_index=True)
            first = first[self.keys[at[first]] == np.uint64(2**64 - 1)]
            self.keys[at[first]], self.vals[at[first]] = left[first], vals[first]
            rest = np.ones(len(left), dtype=bool)
            rest[first] = False
            left, vals, at = left[rest], vals[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, ``_NONE`` where it has none (negative ids never merge)."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = self._home(key)
        out = np.where(self.keys[at] == key, self.vals[at], _NONE)
        todo = np.flatnonzero((out == _NONE) & (self.keys[at] != np.uint64(2**64 - 1)))
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.vals[at[todo[hit]]]
            todo = todo[~hit & (found != np.uint64(2**64 - 1))]
        return np.where((left < 0) | (right < 0), _NONE, out)


class Codec:
    """Encodes pieces to ids and ids back to bytes."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        self.ranks = read_ranks(rank_file)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the rank file lacks {len(missing)} single bytes")
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.pairs = PairTable(self.ranks)
        self.split = regex.compile(pattern).findall
        self.written: dict[str, str] = {}
        self.decoded: dict[str, bytes] = {}

    def _matrix(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """Merge one matrix of pieces, all at most ``width`` bytes."""
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(n, width)
        length = np.fromiter(map(len, pieces), np.int64, n)
        ids = np.where(np.arange(width) < length[:, None], self.byte_ids[raw], np.int32(-1))
        out: list[list[int]] = [[]] * n
        row = np.arange(n)
        rank = (self.pairs.lookup(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
                if width > 1 else np.full((n, 1), _NONE))
        while len(row):
            j = rank.argmin(axis=1)
            best = rank[np.arange(len(row)), j]
            going = best != _NONE
            for k in np.flatnonzero(~going):
                out[row[k]] = ids[k][:length[k]].tolist()
            if not going.all():
                row, ids, rank, j, best, length = row[going], ids[going], rank[going], j[going], best[going], length[going]
                if not len(row):
                    break
            at = np.arange(len(row))
            ids[at, j] = best
            length -= 1
            width = int(length.max())
            keep = np.arange(width)
            ids = np.take_along_axis(ids, keep + (keep > j[:, None]), axis=1)
            if width < 2:
                rank = np.full((len(row), 1), _NONE)
                continue
            keep = keep[:-1]
            # Pair j is gone; the pairs left and right of the merged id get new ranks.
            rank = np.take_along_axis(rank, np.minimum(keep + (keep >= j[:, None]), rank.shape[1] - 1), axis=1)
            has = np.flatnonzero(j > 0)
            rank[has, j[has] - 1] = self.pairs.lookup(ids[has, j[has] - 1], ids[has, j[has]])
            has = np.flatnonzero(j + 1 < width)
            rank[has, j[has]] = self.pairs.lookup(ids[has, j[has]], ids[has, j[has] + 1])
            past = keep >= (length - 1)[:, None]
            rank[past] = _NONE
        return out

    def _long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece: a heap of (rank, position) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        a = np.array(ids)
        rank = self.pairs.lookup(a[:-1], a[1:])
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(rank.tolist()) if r != _NONE]
        heapq.heapify(heap)
        ranks, text = self.ranks, self.bytes_of
        while heap:
            r, i, left, right = heapq.heappop(heap)
            k = after[i]
            if ids[i] != left or k >= n or ids[k] != right:
                continue
            ids[i], ids[k] = r, -1
            after[i] = after[k]
            if after[k] < n:
                before[after[k]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n:
                    y = after[x]
                    merged = ranks.get(text[ids[x]] + text[ids[y]])
                    if merged is not None:
                        heapq.heappush(heap, (merged, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(pieces)
        order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        i = 0
        while i < len(order):
            shortest = len(pieces[order[i]])
            if shortest > MATRIX_BYTES:
                out[order[i]] = self._long(pieces[order[i]])
                i += 1
                continue
            bucket = max(8, 1 << (shortest - 1).bit_length()) if shortest else 8
            top = min(bucket, MATRIX_BYTES)
            k = i
            while k < len(order) and len(pieces[order[k]]) <= top and (k - i + 1) * top <= MATRIX_CELLS:
                k += 1
            group = order[i:k]
            for x, ids in zip(group, self._matrix([pieces[x] for x in group], len(pieces[group[-1]])), strict=True):
                out[x] = ids
            i = k
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that the cache lacks; remember their ids as text and their decoded bytes."""
        if len(self.written) + len(pieces) > CACHE_PIECES:
            self.written.clear()
            self.decoded.clear()
        new = [p for p in pieces if p not in self.written]
        for p, ids in zip(new, self.encode_pieces([p.encode() for p in new]), strict=True):
            self.written[p] = " ".join(map(str, ids))
            self.decoded[p] = self.decode(ids)


_codecs: dict[str, Codec] = {}
keep_cache("byte_bpe", _codecs.clear)


def codec(rank_file: bytes, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    key = hashlib.sha256(rank_file + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(rank_file, pattern)
    return _codecs[key]


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """``id_col``, n_tokens, ids_sha256 and decoded_sha256 of every row; with
    ``with_ids`` also the ids. ``rank_path`` is read on the driver and shipped."""
    ship(docs.sparkSession)
    with open(rank_path, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file, whatever the corpus
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("byte_bpe")
        c = codec(shipped.value, pattern)
        for b in batches:
            for lo, hi in _groups(b.column(1)):
                part = b.slice(lo, hi - lo)
                split = [c.split(t) for t in part.column(1).to_pylist()]
                c.learn(set().union(*split))
                n, digest, back, ids = [], [], [], []
                for pieces in split:
                    text = " ".join(map(c.written.__getitem__, pieces))
                    n.append(text.count(" ") + 1 if text else 0)
                    digest.append(hashlib.sha256(text.encode()).hexdigest())
                    back.append(hashlib.sha256(b"".join(map(c.decoded.__getitem__, pieces))).hexdigest())
                    if with_ids:
                        ids.append(np.fromstring(text, dtype=np.int32, sep=" ") if text else np.zeros(0, np.int32))
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32())))
                yield pa.record_batch(cols, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = np.asarray(pa.compute.utf8_length(texts)).tolist()
    lo, size = 0, 0
    for i, s in enumerate(sizes):
        if i > lo and size + s > GROUP_CHARS:
            yield lo, i
            lo, size = i, 0
        size += s
    if lo < len(sizes):
        yield lo, len(sizes)


def decode(encoded: DataFrame, rank_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and the decoded ``content`` bytes of every row of ids (null ids: null)."""
    ship(encoded.sparkSession)
    with open(rank_path, "rb") as f:
        shipped = encoded.sparkSession.sparkContext.broadcast(f.read())
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {r: t for t, r in read_ranks(shipped.value).items()}
        for b in batches:
            out = [None if x is None else b"".join(map(bytes_of.__getitem__, x)) for x in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(out, pa.binary())], names=["id", "content"])

    return rows.mapInArrow(run, f"id {kind}, content binary").withColumnRenamed("id", id_col)
