"""Operator 12: whitening of embeddings by a covariance from variances alone.

Entries become whole numbers x = floor(scale * c) + shift. One pass sums every
dimension; a second centres each entry at the rounded mean and sums, exactly,
the squares of every dimension and of every sum of two dimensions. With n and
the remainder of the mean these give the exact sums of (n*x - S)^2, that is the
variances of x_i and of x_i + x_j; the polarisation identity

    cov(x_i, x_j) = (var(x_i + x_j) - var(x_i) - var(x_j)) / 2

recovers every cross-covariance without a rounding, and the matrix goes to
``eigh``. Tasks send only sums (in limbs of 32 bits, so that no total overflows),
d * (d + 1) / 2 per length d of vectors; the driver holds that d x d matrix.

Defined cases: vectors that are null, empty or hold a null or non-finite entry
are dropped; vectors of another length have a fit of their own; null or repeated
ids: each row counts and is returned; a component without variance (an eigenvalue
of at most 1e-12 of the largest) has a null ``whitened``; where nothing varies,
``explained`` is null too; ``identity_error`` is taken over the components that
vary (none: 0); entries beyond 2**61 and deviations beyond 64 bits are held at
those limits; an empty table gives an empty result; only the id and vector
columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlens.llm.common import ship, stored

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Rows squared together.
STEP = 512
#: Least share of the largest eigenvalue that counts as variance.
TINY = 1e-12
_MOST = 2.0**61


def vectors_by_length(batch: pa.RecordBatch, scale: int, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole-number vectors of a batch (id, embedding), one length at a time."""
    col = batch.column(1)
    lengths = col.value_lengths().to_numpy(zero_copy_only=False)
    flat, start = col.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths) - lengths
    for d in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == d)
        x = np.floor(scale * flat[start[own][:, None] + np.arange(d)].astype(np.float64))
        yield own, np.clip(x, -_MOST, _MOST).astype(np.int64) + shift


def column_sums(a: np.ndarray) -> list[int]:
    """Exact sums of the columns of whole numbers."""
    most = max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0
    return [int(s) for s in (a if most * len(a) < 2**62 else a.astype(object)).sum(axis=0)]


def squares(z: np.ndarray) -> list[int]:
    """For every pair i <= j in order, the exact sum of (z_i + z_j)^2, with z_i^2 where i = j."""
    most = max(abs(int(z.min())), abs(int(z.max()))) if z.size else 0
    if 4 * most * most * len(z) >= 2**62:
        z = z.astype(object)
    out: list[int] = []
    for i in range(z.shape[1]):
        both = z[:, i:] + z[:, i:i + 1]
        both[:, 0] = z[:, i]
        out += [int(s) for s in (both * both).sum(axis=0)]
    return out


_LIMB = 32
_PARTS = "d int, at int, limb int, value long"


def _limbs(d: int, numbers: list[int]) -> pa.RecordBatch:
    """Rows (d, place, limb, value): the signed numbers in limbs of 32 bits, each with the number's sign."""
    at, limb, value = [], [], []
    for i, x in enumerate(numbers):
        sign, x, k = (-1, -x, 0) if x < 0 else (1, x, 0)
        while x or not k:
            at.append(i)
            limb.append(k)
            value.append(sign * (x & (1 << _LIMB) - 1))
            x, k = x >> _LIMB, k + 1
    return pa.record_batch([pa.array([d] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array(limb, pa.int32()),
                            pa.array(value, pa.int64())], names=["d", "at", "limb", "value"])


def _totals(parts: DataFrame) -> dict[int, dict[int, int]]:
    """Exact totals by length and place; their number depends on the lengths only."""
    out: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("d", "at", "limb").agg(F.sum("value").alias("value")).collect():
        own = out.setdefault(r["d"], {})
        own[r["at"]] = own.get(r["at"], 0) + (r["value"] << _LIMB * r["limb"])
    return out


@dataclass
class Fit:
    """What the vectors of one length were fitted to; x is centred as (x - middle) - rest / n."""
    n: int
    middle: np.ndarray       # rounded-down means, whole numbers
    rest: np.ndarray         # sums less n * middle, in [0, n)
    covariance: np.ndarray
    values: np.ndarray       # eigenvalues, falling
    vectors: np.ndarray      # unit eigenvectors in columns

    def deviation(self, z: np.ndarray) -> np.ndarray:
        """Sum over the dimensions of (n * x - S)^2 for rows z = x - middle, exact."""
        most = self.n * (max(abs(int(z.min())), abs(int(z.max()))) + 1) if z.size else 0
        if most * most * z.shape[1] < 2**63:
            y = self.n * z - self.rest
            return (y * y).sum(axis=1)
        y = self.n * z.astype(object) - self.rest.astype(object)
        return np.array([min(int(s), 2**63 - 1) for s in (y * y).sum(axis=1)], dtype=np.int64)

    def whitened(self, z: np.ndarray, k: int) -> np.ndarray:
        """Rows z = x - middle projected on the first k components and scaled to variance 1; NaN without variance."""
        e = np.where(self.values[:k] > TINY * max(self.values[0], 0), self.values[:k], np.nan)
        return (z.astype(np.float64) - self.rest / self.n) @ self.vectors[:, :k] / np.sqrt(e)


def assemble(n: int, rest: list[int], totals: list[int]) -> np.ndarray:
    """Covariance matrix from the exact sums of squares of dimensions and of sums of two (see :func:`squares`),
    of entries centred at whole numbers that leave the sums ``rest``."""
    d = len(rest)
    i, j = np.triu_indices(d)
    at = {pair: k for k, pair in enumerate(zip(i.tolist(), j.tolist(), strict=True))}
    spread = [n * n * totals[at[a, a]] - n * rest[a] ** 2 for a in range(d)]  # sum of (n x - S)^2
    out = np.empty((d, d))
    for (a, b), k in at.items():
        if a == b:
            out[a, a] = spread[a] / n**3
        else:
            both = n * n * totals[k] - n * (rest[a] + rest[b]) ** 2
            out[a, b] = out[b, a] = (both - spread[a] - spread[b]) / (2 * n**3)
    return out


def fit(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> dict[int, Fit]:
    """The fit of every vector length among ``rows`` (id, embedding; valid vectors only). Two passes."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for b in batches:
            for own, x in vectors_by_length(b, scale, shift):
                new = [*column_sums(x), len(own)]
                sums[x.shape[1]] = [p + q for p, q in zip(sums[x.shape[1]], new, strict=True)] if x.shape[1] in sums else new
        yield from (_limbs(d, s) for d, s in sums.items())

    centres = {}
    for d, got in _totals(rows.mapInArrow(first, _PARTS)).items():
        n = got[d]
        centres[d] = n, [got[i] // n for i in range(d)], [got[i] % n for i in range(d)]
    middles = {d: np.array(middle, dtype=np.int64) for d, (_, middle, _) in centres.items()}

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[int]] = {}
        for b in batches:
            for own, x in vectors_by_length(b, scale, shift):
                d = x.shape[1]
                for lo in range(0, len(own), STEP):
                    new = squares(x[lo:lo + STEP] - middles[d])
                    sums[d] = [p + q for p, q in zip(sums[d], new, strict=True)] if d in sums else new
        yield from (_limbs(d, s) for d, s in sums.items())

    out = {}
    for d, got in _totals(rows.mapInArrow(second, _PARTS)).items():
        n, _, rest = centres[d]
        v = assemble(n, rest, [got[k] for k in range(d * (d + 1) // 2)])
        e, u = np.linalg.eigh(v)
        out[d] = Fit(n, middles[d], np.array(rest, dtype=np.int64), v, e[::-1].copy(), u[:, ::-1].copy())
    return out


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """For every valid row and component: ``id_col``, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    ship(spark)
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    valid = rows.where(v.isNotNull() & (F.size(v) > 0) & ~bad).select(F.col(id_col).alias("id"), v.cast("array<double>").alias("v"))
    fits = fit(valid, scale, shift)
    shipped = spark.sparkContext.broadcast(fits)  # one d x d matrix per length

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for own, x in vectors_by_length(b, scale, shift):
                f = shipped.value[x.shape[1]]
                z = x - f.middle
                w = f.whitened(z, components)
                at = pa.array(np.arange(len(own) + 1) * w.shape[1], pa.int32())
                yield pa.record_batch([b.column(0).take(pa.array(own)), pa.array([x.shape[1]] * len(own), pa.int32()), pa.array(f.deviation(z)),
                                       pa.ListArray.from_arrays(at, pa.array(w.ravel(), from_pandas=True))],
                                      names=["id", "d", "deviation", "w"])

    kind = dict(valid.dtypes)["id"]
    done = stored(valid.mapInArrow(project, f"id {kind}, d int, deviation long, w array<double>"), "whitened")
    error = _identity_errors(done)

    def per_length(of) -> F.Column:
        """A value of each length's fit, chosen by ``d``."""
        out = F.lit(None)
        for d, f in fits.items():
            out = F.when(F.col("d") == d, of(d, f)).otherwise(out)
        return out

    def shares(d: int, f: Fit):
        total = float(np.trace(f.covariance))
        return F.array(*[F.lit(float(x) / total if total > 0 else None).cast("double") for x in f.values[:components]])

    one = done.select("id", "d", "deviation", F.posexplode("w").alias("pos", "whitened"))
    return one.select(F.col("id").alias(id_col), (F.col("pos") + 1).cast("int").alias("component"),
                      per_length(lambda d, f: F.lit(f.n)).cast("long").alias("n"), "deviation", "whitened",
                      F.get(per_length(shares).cast("array<double>"), F.col("pos")).alias("explained"),
                      per_length(lambda d, f: F.lit(error.get(d, 0.0))).cast("double").alias("identity_error"))


def _identity_errors(done: DataFrame) -> dict[int, float]:
    """By length, the largest absolute entry of the whitened vectors' covariance minus the identity, over the
    components that vary: measured on the stored vectors, whose tasks send their sums only."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[np.ndarray]] = {}
        for b in batches:
            d_of, lengths = b.column(0).to_numpy(), b.column(1).value_lengths().to_numpy()
            flat, start = b.column(1).flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths) - lengths
            for d in np.unique(d_of).tolist():
                own = np.flatnonzero(d_of == d)
                w = flat[start[own][:, None] + np.arange(lengths[own[0]])]
                w = np.hstack([w, np.ones((len(w), 1))])  # the last column sums the others and counts
                got[d] = got[d] + w.T @ w if d in got else w.T @ w
        for d, m in got.items():
            yield pa.record_batch([pa.array([d] * m.size, pa.int32()), pa.array(np.arange(m.size), pa.int32()), pa.array(m.ravel())],
                                  names=["d", "at", "value"])

    found: dict[int, dict[int, float]] = {}
    parts = done.select("d", "w").mapInArrow(sums, "d int, at int, value double")
    for r in parts.groupBy("d", "at").agg(F.sum("value").alias("value")).collect():
        found.setdefault(r["d"], {})[r["at"]] = r["value"]
    out = {}
    for d, values in found.items():
        k = round(len(values) ** 0.5)
        m = np.array([values[i] for i in range(k * k)]).reshape(k, k)
        m /= m[-1, -1]
        c = m[:-1, :-1] - np.outer(m[:-1, -1], m[:-1, -1]) - np.eye(k - 1)
        varies = ~np.isnan(np.diag(c))
        out[d] = float(np.abs(c[np.ix_(varies, varies)]).max()) if varies.any() else 0.0
    return out
