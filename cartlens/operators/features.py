"""Feature preparation and evaluation (I1-I9, I13, I14), relational form.

Statistics (medians, means, population std) are one-row aggregates joined
back by broadcast. Evaluation works on per-score / per-(label, prediction)
counts, so its size is independent of the number of rows scored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlens.operators.stats import ordered_prefix, quantiles, with_scalars
from cartlens.schema import MISSING_LEVEL
from cartlens.session import cut_lineage


def present(df: DataFrame, candidates: list[str]) -> list[str]:
    """The candidate features that exist in ``df``, in candidate order."""
    return [c for c in candidates if c in df.columns]


def as_float(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric features as double with NaN read as missing."""
    return df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def impute_median(df: DataFrame, cols: list[str], unbounded: list[str] | None = None,
                  fit_rows: Column | None = None) -> DataFrame:
    """Replace nulls by the column median (exact; a column without values stays null).

    Medians come from all rows (the reference's behaviour) or, with
    ``fit_rows`` (e.g. ``~is_test``), from those rows only and are applied to
    all. All columns are refined together (:func:`cartlens.operators.stats.quantiles`);
    ``unbounded`` (columns with many distinct values) needs no care any more and has no effect.
    """
    # Read by every pass of the medians and by the output: materialise once.
    df = cut_lineage(as_float(df, cols))
    medians = quantiles(df if fit_rows is None else df.where(fit_rows), cols, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(q[0])) for c, q in medians.items() if q})


def standardize(df: DataFrame, cols: list[str], fit_rows: Column | None = None) -> DataFrame:
    """I4: (x - mean) / population std; a constant column is divided by 1.
    Statistics from all rows, or from ``fit_rows`` only."""
    fit = df if fit_rows is None else df.where(fit_rows)
    st = fit.agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols],
                *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
    out = with_scalars(df, st)
    for c in cols:
        sd = F.col(f"_sd_{c}")
        scale = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out = out.withColumn(c, (F.col(c) - F.col(f"_mu_{c}")) / scale)
    return out.drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


def fill_missing_level(df: DataFrame, cols: list[str], level: str = MISSING_LEVEL) -> DataFrame:
    """Categorical nulls become the ``Missing`` level (values as strings)."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(level)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def one_hot_long(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """I6 in long form: one row per (key, categorical feature) with its level
    and dummy name ``<feature>_<level>`` (the value of that dummy is 1; every
    other dummy of the feature is 0)."""
    filled = fill_missing_level(df.select(key, *cols), cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("level"))
                                for c in cols]))
    return (filled.select(key, pairs.alias("_p"))
            .select(key, F.col("_p.feature").alias("feature"), F.col("_p.level").alias("level"),
                    F.concat(F.col("_p.feature"), F.lit("_"), F.col("_p.level")).alias("dummy")))


def prepare_design(df: DataFrame, num_cols: list[str], cat_cols: list[str],
                   fit_rows: Column | None = None) -> DataFrame:
    """Imputed + standardised numerics, categoricals with ``Missing``.

    By default statistics come from all rows, as in the reference (the
    hold-out then leaks slightly); pass ``fit_rows`` to fit on training rows.
    """
    imputed = impute_median(df, num_cols, fit_rows=fit_rows)
    return fill_missing_level(standardize(imputed, num_cols, fit_rows), cat_cols)


def hash_score(key: Column, seed: int) -> Column:
    """First 8 hex digits of md5("<key>:<seed>"), a uniform 32-bit score as text."""
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), 1, 8)


def threshold_hex(fraction: float) -> str:
    return format(min(int(fraction * 2 ** 32), 2 ** 32 - 1), "08x")


def split_flag(df: DataFrame, key: str, test_fraction: float, seed: int,
               name: str = "is_test") -> DataFrame:
    """Deterministic split, no shuffle: a row is in the test part when
    its keyed hash score is below ``test_fraction``. Each row is an
    independent draw, so every class gets ``test_fraction`` of its rows in
    expectation (stratified in proportion; same predicate in SQL)."""
    return df.withColumn(name, hash_score(F.col(key), seed) < F.lit(threshold_hex(test_fraction)))


def exact_split_flag(df: DataFrame, key: str, label: str, test_fraction: float, seed: int,
                     name: str = "is_test") -> DataFrame:
    """I9 exact variant: per class (a null label is a class) exactly
    floor(test_fraction * n_c + 0.5) test rows, those with the smallest keyed hash.

    Rows are ranked inside (class, first three hash digits), 4096 even parts of
    a class, and the parts' counts give each part its offset: no class is
    ranked in one task and nothing goes to the driver.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    part = [F.col("_l"), F.col("_part")]
    rows = df.withColumn("_h", F.substring(digest, 1, 14)).withColumn("_l", F.col(label))
    rows = rows.withColumn("_part", F.substring("_h", 1, 3))
    counts = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy("_l")
    counts = counts.select(
        F.col("_l").alias("_cl"), F.col("_part").alias("_cp"),
        F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.floor(F.sum("_n").over(own) * F.lit(test_fraction) + 0.5).alias("_quota"))
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*part).orderBy("_h")) - 1)
    hit = F.col("_l").eqNullSafe(F.col("_cl")) & F.col("_part").eqNullSafe(F.col("_cp"))
    return (ranked.join(counts, hit).withColumn(name, F.col("_off") + F.col("_r") < F.col("_quota"))
            .drop("_h", "_l", "_part", "_cl", "_cp", "_off", "_quota", "_r"))


def roc_auc(scored: DataFrame, label: str, score: str, buckets: int = 1024) -> DataFrame:
    """Exact ROC-AUC (ties count one half) in one row.

    Rows collapse to (score, positives, negatives); the negatives ranked below
    each score come from a distributed prefix sum, so no task sees more than
    a bucket of distinct scores.
    """
    per = (scored.where(F.col(score).isNotNull())
           .groupBy(F.col(score).cast("double").alias("_s"))
           .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg")))
    pre = ordered_prefix(per, "_s", ["_neg"], buckets)
    return pre.agg(
        (F.sum(F.col("_pos") * (F.col("_neg_before") + F.col("_neg") * 0.5))
         / (F.sum("_pos") * F.sum("_neg"))).alias("auc"))


def confusion_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("string").alias("label"),
                      F.col(pred).cast("string").alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: list[str] | None = None) -> DataFrame:
    """rows = true class, one column per predicted class. Without ``classes`` the columns are
    all labels and predictions that occur (one name per class goes to the driver)."""
    counts = cut_lineage(confusion_counts(df, label, pred))
    if classes is None:
        both = counts.select(F.explode(F.array("label", "pred")).alias("c")).where("c is not null").distinct()
        classes = sorted(r["c"] for r in both.collect())
    return (counts.groupBy("label").pivot("pred", classes).sum("n")
            .fillna(0, subset=classes)
            .select("label", *[F.col(c).cast("long").alias(f"pred_{c}") for c in classes]))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per-class precision, recall, F1 and support, then accuracy, macro
    and weighted averages. An empty denominator gives 0."""
    # (label, prediction) counts: at most classes² rows, read by four branches.
    c = cut_lineage(confusion_counts(df, label, pred))
    true_n = c.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("support"))
    pred_n = c.groupBy(F.col("pred").alias("cls")).agg(F.sum("n").alias("predicted"))
    hit = c.where(F.col("label") == F.col("pred")).select(F.col("label").alias("cls"), F.col("n").alias("tp"))
    per = (true_n.join(pred_n, "cls", "full").join(hit, "cls", "left")
           .fillna(0, subset=["support", "predicted", "tp"]))

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    per = (per.withColumn("precision", ratio(F.col("tp"), F.col("predicted")))
           .withColumn("recall", ratio(F.col("tp"), F.col("support")))
           .withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"),
                                   F.col("precision") + F.col("recall"))))
    total = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                    F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                    (F.sum(F.col("precision") * F.col("support"))).alias("wp"),
                    (F.sum(F.col("recall") * F.col("support"))).alias("wr"),
                    (F.sum(F.col("f1") * F.col("support"))).alias("wf"))
    rows = per.select(F.col("cls").alias("class_name"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    acc = total.select(F.lit("accuracy").alias("class_name"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1"),
                       F.col("n").cast("long").alias("support"))
    macro = total.select(F.lit("macro avg").alias("class_name"), F.col("mp").alias("precision"),
                         F.col("mr").alias("recall"), F.col("mf").alias("f1"),
                         F.col("n").cast("long").alias("support"))
    weighted = total.select(F.lit("weighted avg").alias("class_name"), (F.col("wp") / F.col("n")).alias("precision"),
                            (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                            F.col("n").cast("long").alias("support"))
    out = rows.unionByName(acc).unionByName(macro).unionByName(weighted)
    return out.select("class_name", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")
