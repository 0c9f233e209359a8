"""Aggregation helpers shared by the operators.

Scalars (a max date, quantile breaks, a median) are one-row DataFrames that
are cross-joined back with a broadcast hint: one row is a proven size bound,
and nothing goes through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.session import cut_lineage


def money_sum(c) -> Column:
    """Sum of money as doubles; NaN counts as missing, a group without any value is 0.0."""
    col = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.coalesce(F.sum(F.nanvl(col, F.lit(None).cast("double"))), F.lit(0.0))


def with_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row (broadcast, no shuffle)."""
    return df.crossJoin(F.broadcast(scalars))


def percentiles(c, probs: list[float]) -> Column:
    """Exact linearly interpolated percentiles (same values as pandas ``quantile``).

    The final merge of Spark's exact ``percentile`` holds a value -> count map,
    so its memory is bounded by the number of *distinct* values; use it for
    day counts, order counts and money rounded to cents. For unbounded
    distinct counts use :func:`quantiles`.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.percentile(col, F.array(*[F.lit(float(p)) for p in probs]))


def _sketch_buckets(df: DataFrame, col: str, buckets: int, out: str) -> DataFrame:
    """Tag rows with an equi-depth bucket of ``col`` (ascending, 0-based).

    Bounds come from a quantile sketch: a list of at most ``buckets - 1``
    numbers, the only thing that reaches the driver. ``Bucketizer`` then
    places every row by binary search in the JVM.
    """
    from pyspark.ml.feature import Bucketizer
    grid = [i / buckets for i in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(F.col(col).cast("double"), grid, 10 * buckets)).first()[0] or []
    # An empty or all-null column has no bounds; Bucketizer wants at least one.
    splits = [float("-inf")] + (sorted({float(b) for b in bounds}) or [0.0]) + [float("inf")]
    tmp = f"_{out}_x"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return (b.transform(df.withColumn(tmp, F.col(col).cast("double")))
            .withColumn(out, F.col(out).cast("int")).drop(tmp))


#: Bins of a column's histogram in one pass.
QUANTILE_BINS = 1 << 14


def _bin(x: Column, low: float, high: float, bins: int) -> Column:
    """The bin of a value in [low, high], ascending: of its logarithm where the range is unbounded (``low`` is
    ``-inf`` or ``high`` is ``inf``), else linear."""
    def log(v: Column) -> Column:
        return F.when(F.abs(v) == float("inf"), F.signum(v) * 711.0).otherwise(F.signum(v) * F.log1p(F.abs(v)))  # ln of the largest double: 709.8
    if low == float("-inf") or high == float("inf"):
        at = (log(x) - log(F.lit(low))) / (log(F.lit(high)) - log(F.lit(low)))
    else:
        half = 2.0 if max(-low, high) > 1e300 else 1.0  # the difference of two halves cannot overflow
        at = (x / half - low / half) / (high / half - low / half)
    return F.least(F.floor(at * bins), F.lit(bins - 1)).cast("int")


def quantiles(df: DataFrame, columns: list[str], probs: list[float], bins: int = QUANTILE_BINS) -> dict[str, list[float]]:
    """Exact interpolated quantiles (pandas ``quantile``) of all columns together, by histogram refinement.

    A pass counts, for every column and range that still holds a wanted rank, the values by bin with the least and
    largest of each bin; the bins that hold the ranks are the next ranges, until a range is one value. At most
    columns x ranks x ``bins`` rows are shuffled in a pass, whatever the number of distinct values, and a number per
    rank reaches the driver. The first ranges are logarithmic, so a few passes are enough for money, too. Nulls and
    NaN are left out; a column without values has no quantiles. ``df`` is read in every pass: pass a
    materialised one if it is dear, or not the same in all its digits each time (sums of doubles).
    """
    if not columns:
        return {}
    number = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns}
    rows = df.select(*[number[c].alias(f"c{i}") for i, c in enumerate(columns)])
    seen = rows.agg(*[f(f"c{i}").alias(f"{name}{i}") for i in range(len(columns))
                      for name, f in (("n", F.count), ("low", F.min), ("high", F.max))]).first()
    places = {}       # (column, rank) -> (low, high, values below low)
    for i in range(len(columns)):
        for p in probs if seen[f"n{i}"] else []:
            at = p * (seen[f"n{i}"] - 1)
            for r in {math.floor(at), math.ceil(at)}:
                places[i, r] = seen[f"low{i}"], seen[f"high{i}"], 0
    first = True
    while open_ := sorted({(i, *place) for (i, _), place in places.items() if place[0] < place[1]}):
        entries, ranks = [], []
        for g, (i, low, high, below) in enumerate(open_):
            x = F.col(f"c{i}")
            digit = _bin(x, float("-inf"), float("inf"), 4 * bins) if first else _bin(x, low, high, bins)
            entries.append(F.when((x >= low) & (x <= high), F.struct(F.lit(g).alias("g"), digit.alias("bin"), x.alias("x"))))
            ranks.append(F.array(*[F.lit(r - below).cast("long") for (j, r), place in sorted(places.items()) if (j, *place) == (i, low, high, below)]))
        counts = (rows.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
                  .groupBy("g", "bin").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")))
        upto = F.sum("n").over(Window.partitionBy("g").orderBy("bin"))
        held = F.filter(F.get(F.array(*ranks), F.col("g")), lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
        found = counts.withColumn("upto", upto).select("g", "low", "high", (F.col("upto") - F.col("n")).alias("before"), F.explode(held).alias("r"))
        for f in found.collect():
            i, low, high, below = open_[f["g"]]
            places[i, f["r"] + below] = f["low"], f["high"], f["before"] + below
        first = False
    out = {}
    for i, c in enumerate(columns):
        at = [p * (seen[f"n{i}"] - 1) for p in probs] if seen[f"n{i}"] else []
        ends = [(places[i, math.floor(x)][0], places[i, math.ceil(x)][0], x - math.floor(x)) for x in at]
        out[c] = [a if a == b else a + (b - a) * part for a, b, part in ends]
    return out


def one_row(df: DataFrame, **values) -> DataFrame:
    """A one-row frame of numbers and lists of numbers, built in the JVM."""
    cols = [(F.array(*[F.lit(float(x)) for x in v]).cast("array<double>") if isinstance(v, list) else F.lit(v).cast("double")).alias(k)
            for k, v in values.items()]
    return df.sparkSession.range(1).select(*cols)


def distributed_quantiles(df: DataFrame, c: str, probs: list[float],
                          buckets: int = QUANTILE_BINS, materialize: bool = True) -> DataFrame:
    """:func:`quantiles` of one column as a one-row frame: a ``q`` array aligned with ``probs`` (empty without
    values). The column is checkpointed first unless ``materialize=False`` (when ``df`` is itself a checkpoint)."""
    rows = df.select(c)
    return one_row(df, q=quantiles(cut_lineage(rows) if materialize else rows, [c], probs, buckets)[c])


def ordered_prefix(df: DataFrame, order_col: str, sum_cols: list[str],
                   buckets: int = 1024) -> DataFrame:
    """Add ``<c>_before``: the sum of ``c`` over all rows with a smaller
    ``order_col`` (exclusive prefix sum in global order), for each ``c``.

    ``order_col`` should be unique (aggregate ties first). A global running
    sum would put every row in one window task; instead rows are split into
    ``buckets`` equi-depth ranges from a sketch, bucket totals (at most
    ``buckets`` rows) give each range its offset, and the running sum runs
    per range in parallel.
    """
    tagged = _sketch_buckets(cut_lineage(df), order_col, buckets, "_bucket")
    totals = tagged.groupBy("_bucket").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    w_all = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(f"_t_{c}").over(w_all), F.lit(0)).alias(f"_o_{c}")
                                         for c in sum_cols])
    w = Window.partitionBy("_bucket").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    out = tagged.join(F.broadcast(offsets), "_bucket")
    for c in sum_cols:
        out = out.withColumn(f"{c}_before", F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0)))
    return out.drop("_bucket", *[f"_o_{c}" for c in sum_cols])
