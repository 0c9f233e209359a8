"""Operator 11: best-fit packing planned over a histogram of lengths.

Every text is tokenised once. A document's ids (an end id is added) are cut into
pieces of at most ``capacity`` tokens; a piece carries its length, a digest and
its rank among the pieces of its length in its task. The histogram of lengths,
at most ``capacity`` numbers, is planned on the driver: lengths go from long to
short, each into the open sequences with the least room that still holds it. The
plan works on groups of sequences with equal contents, so its cost follows the
number of lengths, not of documents. Its slots of one length are numbered, and a
piece takes the slot whose number is its rank among all pieces of its length
(rank in its task plus the counts of earlier tasks); no group of equal lengths
meets in one task.

Size of the plan: a length adds at most three groups, and a sequence holds fewer
than sqrt(2 * capacity) different lengths, so it has at most
3 * capacity * sqrt(2 * capacity) entries (in practice a few thousand).

Tokenising: the vocabulary drops white space, so a text's ids are those of its
words (cut at ASCII white space) one after the other; a worker remembers words.
New words of plain letters go to the library's model directly, others to the
library, many to a line.

Defined cases: a null or empty text is the end id alone, one piece of length 1;
a text of any length is encoded whole; equal lengths take slots in the order of
task and row; null or repeated ids: every row is packed for itself; an empty
table gives an empty result; only the id and text columns are read, so extra
columns cannot clash.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlens.llm.common import enter, keep_cache, ship, stored

CAPACITY, END_ID = 4096, 1
#: Words that a worker remembers, words on a line, lines in a call, texts encoded together.
CACHE_WORDS, LINE_WORDS, CALL_LINES, TEXTS = 400_000, 128, 64, 250
#: The word between the words of a line.
MARK = b"\x01"
#: Tasks whose counts are summed in one window group; longer lists go through sums of such groups.
TASKS_PER_GROUP = 1_024

#: Words of Latin letters with one spelling (A to Z and U+00C0 to U+00FF without the two signs) and stops after them.
PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?]*)").fullmatch


def _letters_of_bytes() -> dict[int, int]:
    """The letter by which a byte-level vocabulary writes each byte: printable ones stand for themselves, the others
    follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in own)}


LETTER_OF_BYTE = _letters_of_bytes()


class WordEncoder:
    """Texts (UTF-8 bytes) to their ids as little-endian 32-bit numbers."""

    def __init__(self, file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_buffer(file)
        mark = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None  # the id of no other word, as its one byte is in none
        self.raw = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.known: dict[bytes, bytes] = {}
        self.met: set[bytes] = set()  # known words that were met again
        self.stops: dict[bytes, bytes] = {b"": b""}

    def _alone(self, words: list[bytes]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False):
            yield np.array(e.ids, dtype="<u4").tobytes()

    def _plain(self, word: bytes) -> bytes:
        """A word of plain letters by the model alone: lower case is all that the library changes in it."""
        letters = word.lower().decode() if word.isascii() else word.decode().lower().encode().decode("latin-1").translate(LETTER_OF_BYTE)
        raw = self.raw
        return b"".join([raw[t.id] for t in self.tokenizer.model.tokenize(letters)])

    def _lines(self, words: list[bytes]) -> None:
        """Other words by the library, many to a call, in lines with a mark between them."""
        odd = [w for w in words if self.mark is None or MARK in w]
        self.known.update(zip(odd, self._alone(odd), strict=True))
        words = [w for w in words if w not in self.known] if odd else words
        lines = [words[i:i + LINE_WORDS] for i in range(0, len(words), LINE_WORDS)]
        between = (b" " + MARK + b" ").join
        for lo in range(0, len(lines), CALL_LINES):
            part = lines[lo:lo + CALL_LINES]
            encoded = self.tokenizer.encode_batch_fast([between(x).decode() for x in part], add_special_tokens=False)
            for own, e in zip(part, encoded, strict=True):
                ids = np.array(e.ids, dtype="<u4")
                marks, raw = np.flatnonzero(ids == self.mark), ids.tobytes()
                begin, end = [0, *(4 * marks + 4).tolist()], [*(4 * marks).tolist(), len(raw)]
                self.known.update(zip(own, [raw[i:j] for i, j in zip(begin, end, strict=True)], strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        words = set().union(*split)
        new = words.difference(self.known)
        self.met |= words - new
        if len(self.known) + len(new) > CACHE_WORDS:  # what was not met again is forgotten, or all but these texts' words
            keep = self.met if len(self.met) + len(new) <= CACHE_WORDS else words - new
            self.known, self.met = {w: self.known[w] for w in keep}, set()
        known, stops, other = self.known, self.stops, []
        for w in new:
            plain = PLAIN(w)
            if plain is None:
                other.append(w)
                continue
            stem, stop = plain.groups()
            if not stop:
                known[w] = self._plain(w)
                continue
            ids = known.get(stem)
            if ids is None:
                ids = known[stem] = self._plain(stem)
            if stop not in stops:
                stops[stop] = next(self._alone([stop]))
            known[w] = ids + stops[stop]  # to the library, stops after a letter are a word of their own
        self._lines(other)
        return [b"".join(map(known.__getitem__, x)) for x in split]


_encoders: dict[int, WordEncoder] = {}
keep_cache("packing", _encoders.clear)


def encoder(file: bytes) -> WordEncoder:
    """One encoder per worker and vocabulary."""
    key = zlib.crc32(file)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(file)
    return _encoders[key]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length and ids_crc32 of every piece, with its ``task`` and its ``nth``
    place among the pieces of its length there. ``tokenizer_path`` is read on the driver and shipped."""
    ship(docs.sparkSession)
    with open(tokenizer_path, "rb") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file, whatever the corpus
    rows = docs.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("packing")
        e, task = encoder(shipped.value), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            groups = (b.column(1).slice(lo, TEXTS).to_pylist() for lo in range(0, b.num_rows, TEXTS))
            for i, ids in enumerate(x for texts in groups for x in e.encode(texts)):
                ids += end
                for lo in range(0, len(ids), 4 * capacity):
                    part = ids[lo:lo + 4 * capacity]
                    row.append(i)
                    piece.append(lo // (4 * capacity))
                    start.append(lo // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            n = np.array(length, np.int64)
            order = np.argsort(n, kind="stable")
            first = np.searchsorted(n[order], n[order])  # where its length begins
            nth = np.empty_like(n)
            nth[order] = np.arange(len(n)) - first + seen[n[order]]
            seen += np.bincount(n, minlength=capacity + 1)
            yield pa.record_batch([b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                   pa.array(n), pa.array(crc, pa.int64()), pa.array([task] * len(n), pa.int64()), pa.array(nth)],
                                  names=["id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, task long, nth long")


class Plan:
    """Slots by length: rows (length, first rank, first sequence, pieces per sequence, offset), ordered by length
    and rank. From its first rank on, an entry's pieces fill one sequence after the other."""

    def __init__(self, histogram: Mapping[int, int], capacity: int = CAPACITY):
        self.capacity, self.n_sequences = capacity, 0
        entries: list[tuple[int, int, int, int, int]] = []
        rooms: list[int] = []                       # the rooms that open groups have, ascending
        groups: dict[int, list[tuple[int, int]]] = {}   # room -> (first sequence, sequences)

        def keep(room: int, first: int, n: int) -> None:
            if room and n:
                if room not in groups:
                    groups[room] = []
                    insort(rooms, room)
                groups[room].append((first, n))

        for length in sorted((x for x, n in histogram.items() if n), reverse=True):
            if not 0 < length <= capacity:
                raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
            left, rank = histogram[length], 0
            while left:
                at = bisect_left(rooms, length)
                if at < len(rooms):
                    room = rooms[at]
                    first, n = groups[room].pop()
                    if not groups[room]:
                        del groups[room], rooms[at]
                else:  # as many new sequences as the rest needs
                    room, first = capacity, self.n_sequences
                    n = -(-left // (capacity // length))
                    self.n_sequences += n
                each = room // length
                full = min(n, left // each)
                if full:
                    entries.append((length, rank, first, each, capacity - room))
                    keep(room - each * length, first, full)
                    rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
                if n and left:  # fewer than one sequence could take
                    entries.append((length, rank, first, left, capacity - room))
                    keep(room - left * length, first, 1)
                    rank, left, first, n = rank + left, 0, first + 1, n - 1
                keep(room, first, n)
        entries.sort()
        self.length, self.rank, self.first, self.each, self.offset = (
            np.array([e[i] for e in entries], dtype=np.int64) for i in range(5))
        self.lengths, self.begin = np.unique(self.length, return_index=True)
        self.end = np.append(self.begin[1:], len(entries))

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece, by its length and its rank within that length."""
        at = np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for own in np.split(order, cuts) if len(order) else []:
            k = np.searchsorted(self.lengths, length[own[0]])
            lo, hi = self.begin[k], self.end[k]
            at[own] = lo + np.searchsorted(self.rank[lo:hi], rank[own], side="right") - 1
        nth = rank - self.rank[at]
        return self.first[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def _bases(counts: DataFrame) -> DataFrame:
    """For every (task, length), the pieces of that length in earlier tasks: sums within groups of
    ``TASKS_PER_GROUP`` tasks and over those groups."""
    counts = counts.withColumn("many", F.floor(F.col("task") / TASKS_PER_GROUP))

    def before(*by: str, order: str):
        return F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = (counts.groupBy("length", "many").agg(F.sum("n").alias("n"))
              .select("length", "many", before("length", order="many").alias("earlier")))
    own = counts.select("task", "length", "many", before("length", "many", order="task").alias("base"))
    return own.join(groups, ["length", "many"]).select("task", "length", (F.col("base") + F.col("earlier")).alias("base"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: ``id_col``, piece, start, length, ids_crc32, sequence_id and offset."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")  # ranks hold from here on
    counts = stored(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    shipped = spark.sparkContext.broadcast(Plan(histogram, capacity))  # bounded by the number of lengths
    ranked = (cut.join(_bases(counts), ["task", "length"])
              .select("id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = shipped.value.place(b.column(3).to_numpy(), b.column(5).to_numpy())
            yield pa.record_batch([*b.columns[:5], pa.array(sequence), pa.array(offset)],
                                  names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = dict(cut.dtypes)["id"]
    out = ranked.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
