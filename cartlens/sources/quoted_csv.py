"""A1: records of quoted CSV files, read by many tasks at once.

A quoted field may hold line breaks, so a byte range of a file cannot tell from
itself where its first record begins. A prefix scan of quote parity tells it: a
line begins inside quotes when the number of quotes before it in its file is odd
(a quote in a quoted field is doubled, which leaves the parity alone).

1. Spark's text source reads lines in byte ranges; an aggregate counts the quotes
   of every range, one row each.
2. Those counts, added up along each file, give every range its starting parity.
3. Every range walks its lines once and joins them to records. What it cannot
   finish itself (lines before its first record, and a record still open at its
   end) are at most two fragments, which are put together by file.

Files must be quoted by these rules (RFC 4180): fields with a quote, a comma or a
line break stand in quotes, quotes inside are doubled. A file with an odd number
of quotes is refused. Empty lines between records are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlens.session import cut_lineage, ship_package

_RECORDS = "range long, nth long, kind int, text string"
#: A whole record; lines that end an earlier record; a record that a later range ends; lines inside one.
WHOLE, TAIL, HEAD, MIDDLE = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with their file and the byte range that holds them, in order within each range."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line")))


def range_parities(lines: DataFrame) -> DataFrame:
    """(file, block, odd): whether a range begins inside quotes. One row per range."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counts = cut_lineage(lines.groupBy("file", "block").agg(F.sum(quotes).alias("n")))
    broken = [r["file"] for r in counts.groupBy("file").agg((F.sum("n") % 2).alias("odd")).where("odd = 1").select("file").limit(3).collect()]
    if broken:
        raise ValueError(f"an odd number of quotes in {', '.join(broken)}")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("odd"))


class _Range:
    """One byte range: takes lines in order and gives records and fragments."""

    def __init__(self, number: int, odd: bool):
        self.number, self.odd, self.nth = number, odd, 0
        self.open: list[pa.Array] = []  # lines of the record that is not finished
        self.first = odd                # that record began in an earlier range

    def take(self, lines: pa.Array) -> pa.RecordBatch:
        quotes = np.asarray(pc.count_substring(lines, '"'), dtype=np.int64)
        inside = (np.cumsum(quotes) + self.odd) % 2 == 1     # after each line
        ends = np.flatnonzero(~inside) + 1                   # behind lines that finish a record
        self.odd = bool(inside[-1])
        if not len(ends):
            self.open.append(lines)
            return self._batch(lines.slice(0, 0))
        held = sum(map(len, self.open))
        whole = pa.concat_arrays([*self.open, lines.slice(0, int(ends[-1]))])
        self.open = [lines.slice(int(ends[-1]))] if ends[-1] < len(lines) else []
        return self._batch(_joined(whole, ends + held))

    def finish(self) -> pa.RecordBatch:
        lines = pa.concat_arrays(self.open) if self.open else pa.array([], pa.string())
        return self._batch(_joined(lines, np.array([len(lines)] if len(lines) else [], np.int64)), MIDDLE if self.first else HEAD)

    def _batch(self, texts: pa.Array, kind: int = WHOLE) -> pa.RecordBatch:
        n = len(texts)
        kinds, nth = np.full(n, kind, np.int32), np.arange(self.nth, self.nth + n)
        if n and kind == WHOLE and self.first:
            kinds[0], self.first = TAIL, False
        self.nth += n
        return pa.record_batch([pa.array(np.full(n, self.number, np.int64)), pa.array(nth), pa.array(kinds), texts.cast(pa.string())],
                               names=["range", "nth", "kind", "text"])


def _joined(lines: pa.Array, ends: np.ndarray) -> pa.Array:
    """The lines up to each end as one text, joined by line breaks."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), lines), "\n")


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Range | None = None
    for b in batches:
        if not b.num_rows:
            continue
        number = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if now is None or now.number != number[lo]:
                if now is not None:
                    yield now.finish()
                now = _Range(int(number[lo]), b.column(1)[lo].as_py())
            yield now.take(b.column(2).slice(lo, hi - lo))
    if now is not None:
        yield now.finish()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, nth, text): every record of the files below ``path``, with the byte range where it
    begins and its place there; line breaks inside quotes are kept, the record's own line end is not."""
    ship_package(spark)
    lines = _lines(spark, path)
    # A row per range; its number stands for file and block, which would outweigh short lines.
    ranges = F.broadcast(cut_lineage(range_parities(lines).withColumn("range", F.monotonically_increasing_id())))
    # The lines of a range stay in their task and order: the join keeps the lines' side as it is.
    parts = (lines.join(ranges, ["file", "block"]).select("range", "odd", "line").mapInArrow(_join_lines, _RECORDS)
             .join(ranges.drop("odd"), "range"))
    rest = parts.where(F.col("kind") != WHOLE)     # at most two of each range
    along = Window.partitionBy("file").orderBy("block", "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = rest.withColumn("record", F.sum((F.col("kind") == HEAD).cast("int")).over(along))
    pieces = F.array_sort(F.collect_list(F.struct("block", "nth", "text")))
    joined = (rest.groupBy("file", "record").agg(pieces.alias("p"))
              .select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["nth"].alias("nth"),
                      F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("text")))
    every = parts.where(F.col("kind") == WHOLE).select("file", "block", "nth", "text").unionByName(joined)
    return every.withColumn("text", F.regexp_replace("text", "\r$", "")).where("text <> ''")


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Every record as strings under ``columns``, without each file's header; ``position`` (file, block, nth) orders them."""
    records = read_records(spark, path)
    # Each file's first record is its header: the first of the range that begins at byte 0.
    data = records.where(~((F.col("block") == 0) & (F.col("nth") == 0)))
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv("text", F.lit(schema), {"escape": '"', "mode": "FAILFAST", "maxCharsPerColumn": "-1", "emptyValue": ""})
    return data.select(F.struct("file", "block", "nth").alias("position"), parsed.alias("r")).select(
        "position", *[F.col("r")[c].alias(c) for c in columns])
