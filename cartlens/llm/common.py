"""Helpers shared by the training-data operators: shared scratch tables and
vectorised splitting of UTF-8 text into hashed words.

Text is handled as the bytes of an Arrow string column, so that a batch of
documents is tokenised by a few numpy passes and no Python string is made.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import unicodedata
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cartlens.session import checkpoint_dir

#: Bytes of text handled by one numpy pass (a single longer text is one pass).
PASS_BYTES = 1_000_000
#: Rows in an Arrow batch: it is held by the executor and by its Python worker, twice over.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_ODD = np.uint64(0x9E3779B97F4A7C15)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: send it with the application, once,
    as ``--py-files`` would (the driver serves the archive to the executors). Texts
    are long, so Arrow batches are kept to ``BATCH_ROWS`` rows unless the session says otherwise."""
    if spark.conf.get(_BATCH) == "10000":  # Spark's default
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    sc = spark.sparkContext
    if any(name.startswith("cartlens-") for name in sc._python_includes):
        return
    import cartlens
    root = Path(cartlens.__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cartlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = Path(folder) / f"cartlens-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))


_caches: dict[str, Callable[[], None]] = {}


def keep_cache(operator: str, clear: Callable[[], None]) -> None:
    """Register how to clear what an operator remembers in this Python worker."""
    _caches[operator] = clear


def enter(operator: str) -> None:
    """Called where a task of an operator begins: workers are reused, so free what other
    operators remember and hand the freed pages back to the system."""
    for name, clear in _caches.items():
        if name != operator:
            clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cartlens-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage
    ends there, and a lost executor costs no recomputation of what led to it.
    ``parts`` merges partitions to at most so many files (of a table whose size is known)."""
    path = scratch(df.sparkSession, name)
    (df if parts is None else df.coalesce(parts)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Files for a table of so many rows: never fewer than the cluster runs tasks."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_part))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the result."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix(b + np.uint64(1))


_LOWERED, _AS_IS = _byte_values(True), _byte_values(False)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
keep_cache("powers", _powers.clear)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse modulo 2^64."""
    size = 1 << max(16, int(n).bit_length())
    if size not in _powers:
        up = np.full(size, _BASE)
        down = np.full(size, _INV)
        up[0] = down[0] = 1
        if len(_powers) > 2:
            _powers.clear()
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def prefix_hash(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Karp-Rabin prefix sums: entry i covers the first i bytes of ``data``."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWERED if lower else _AS_IS)[data] * powers(len(data))[0][:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end): equal bytes have equal hashes."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


#: Word separators: space and U+0009..U+000D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true ``inside`` bytes; runs also end at ``starts``
    (the first byte of each document)."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = starts[starts < len(inside)]
    first[cut] = inside[cut]
    s = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return s, np.flatnonzero(last) + 1


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string column; a null is an empty text."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def passes(offsets: np.ndarray, limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (or of one row)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each white-space separated word of a pass, the row it stands in
    (ascending) and its start byte. A-Z are read as a-z when ``lower``."""
    s, e = spans(~SPACE[data], offsets[:-1])
    h = span_hash(prefix_hash(data, lower), s, e)
    return h, np.searchsorted(offsets, s, side="right") - 1, s


#: First and last code points of scripts written without spaces between words.
UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x3005, 0x3007),
            (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF),
            (0xA980, 0xA9FF), (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF)]
_GAP, _PART, _ALONE = 0, 1, 2
_BYTE_KIND = np.zeros(256, dtype=np.uint8)
_BYTE_KIND[48:58] = _BYTE_KIND[65:91] = _BYTE_KIND[97:123] = _BYTE_KIND[128:] = _PART


@cache
def _char_kinds() -> np.ndarray:
    """Whether a code point from 128 on separates words, is part of one or is one."""
    out = np.full(0x200000, _PART, dtype=np.uint8)
    for a, b in UNSPACED:
        out[a:b + 1] = _ALONE
    out[[c for c in range(128, 0x20000) if unicodedata.category(chr(c))[0] in "PZ" or unicodedata.category(chr(c)) == "Cc"]] = _GAP
    out[[0x200B, 0x2060, 0xFEFF]] = _GAP  # zero width
    return out


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word of a pass, and the row it stands in (ascending). Words are runs of
    letters, digits and other characters from 128 on but punctuation and spaces; in scripts
    without spaces every character is a word."""
    kind, starts = _BYTE_KIND[data], offsets[:-1]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        width = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        padded = np.append(data, np.zeros(3, np.uint8))
        code = data[lead].astype(np.int32) & (0x7F >> width)
        for i in (1, 2, 3):
            code = np.where(width > i, code << 6 | padded[lead + i] & 63, code)
        found = _char_kinds()[code]
        for i in range(4):
            odd = (found == _GAP) & (width > i) & (lead + i < len(data))
            kind[lead[odd] + i] = _GAP
        alone = found == _ALONE
        starts = np.concatenate([starts, lead[alone], lead[alone] + width[alone]])
    s, e = spans(kind != _GAP, starts)
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def shingles(h: np.ndarray, row: np.ndarray, k: int, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's k consecutive words, with the row of each; a row of
    fewer words gives its whole sequence as one, a row without words none."""
    n = np.bincount(row, minlength=n_rows)
    first = np.cumsum(n) - n
    take = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    rows = np.repeat(np.arange(n_rows), take)
    at = np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take) + first[rows]
    out = mix(np.minimum(n, k)[rows].astype(np.uint64))
    last = (first + n)[rows]
    for i in range(k):
        has = at + i < last
        out = np.where(has, out * _ODD + h[np.minimum(at + i, len(h) - 1)] if len(h) else out, out)
    return mix(out), rows
