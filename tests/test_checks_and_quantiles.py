"""The check suite against the single checks and by its plan; histogram-refined quantiles against pandas."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cartlens.operators import check_suite, quality, stats
from cartlens.operators.check_suite import Check

CHECKS = [
    Check("null", "null_key", "child", ("u",)), Check("twice", "duplicate", "child", ("u",)), Check("pair", "duplicate", "child", ("u", "s")),
    Check("ref", "foreign_key", "child", ("u",), ("parent", "u")),
    Check("ref if", "foreign_key", "child", ("u",), ("parent", "u"), ("s", "free")),
    Check("domain", "domain", "child", ("s",), values=("x", "free")), Check("missing", "missing", "child", ("v",)),
    Check("negative", "negative", "child", ("v",)), Check("empty", "empty", "child", ("s", "u", "d"), values=("free",)),
]
SCHEMA = "u string, s string, v double, d date"


def tables(spark, tmp_path, rows, parents):
    child, parent = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(p,) for p in parents], "u string")
    child.write.parquet(f"{tmp_path}/child")
    parent.write.parquet(f"{tmp_path}/parent")
    return {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("child", "parent")}


def test_suite_equals_the_single_checks(spark, tmp_path):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", "z", "1:a", None]), r.choice(["x", "free", "odd", None]), r.choice([1.0, -1.0, None]), None) for _ in range(300)]
    t = tables(spark, tmp_path, rows, ["a", "a", "b", "q", None])
    got = {x["check_name"]: x for x in check_suite.report(t, CHECKS).collect()}
    child, parent = t["child"], t["parent"]

    def one(df):
        return df.first()[0]
    assert got["null"]["bad_rows"] == one(quality.null_key_count(child, "u"))
    for name, key in (("twice", ["u"]), ("pair", ["u", "s"])):
        want = quality.duplicate_keys(child, key).collect()
        assert got[name]["bad_rows"] == sum(x["num_rows"] for x in want)
    assert got["pair"]["bad_keys"] == len(quality.duplicate_keys(child, ["u", "s"]).collect())
    assert got["ref"]["bad_rows"] == one(quality.fk_violation_count(child, parent, "u", "u"))
    assert got["ref"]["bad_keys"] == quality.fk_orphan_keys(child, parent, "u", "u").count()
    assert got["ref"]["matched_keys"] == 2 and got["ref"]["matched_pairs"] == 3
    assert got["ref if"]["bad_rows"] == one(quality.conditional_fk_count(child, parent, "u", "u", "s", "free"))
    assert got["domain"]["bad_rows"] == one(quality.domain_violations(child, "s", ["x", "free"]))
    assert tuple(quality.numeric_range(child, "v").first()) == (got["missing"]["bad_rows"], got["negative"]["bad_rows"])
    assert got["empty"]["bad_rows"] == one(quality.empty_row_count(child, "s", "free", "u", ["d"]))
    keys = {(x["check_name"], x["key"]): x["num_rows"] for x in check_suite.violating_keys(check_suite.counts(t, CHECKS), CHECKS).collect()}
    assert keys["ref", None] == got["null"]["bad_rows"] and ("ref", "z") in keys and ("ref", "a") not in keys


def test_suite_reads_each_table_once(spark, tmp_path):
    t = tables(spark, tmp_path, [("a", "x", 1.0, None)], ["a"])
    plan = check_suite.counts(t, CHECKS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    empty = {n: df.limit(0) for n, df in t.items()}
    got = check_suite.report(empty, CHECKS).collect()
    assert len(got) == len(CHECKS) and all(x["bad_rows"] == x["bad_keys"] == 0 for x in got)


@pytest.mark.parametrize("bins", [64, stats.QUANTILE_BINS])
def test_quantiles_equal_pandas(spark, bins):
    r = np.random.default_rng(5)
    n = 700
    frame = pd.DataFrame({
        "money": np.round(r.lognormal(3, 2, n), 2), "days": r.integers(0, 40, n).astype(float), "one": np.full(n, 7.5),
        "signs": r.normal(0, 1, n) * 10.0 ** r.integers(-200, 200, n), "near": 1 + r.integers(0, 50, n) * 2.0**-52,
        "wide": r.choice([-1.7e308, -5e-324, 0.0, 5e-324, 1.7e308], n), "inf": r.choice([-np.inf, 1.0, 2.0, np.inf], n, p=[0.01, 0.49, 0.49, 0.01]),
        "few": np.where(r.random(n) < 0.9, np.nan, r.random(n)), "none": np.full(n, np.nan)})
    df = spark.createDataFrame(frame).repartition(3)
    df = df.withColumn("few", F.when(~F.isnan("few"), F.col("few")))
    probs = [0.0, 0.2, 0.5, 0.77, 0.999, 1.0]
    got = stats.quantiles(df, list(frame.columns), probs, bins)
    for c in frame.columns:
        values = frame[c].dropna().sort_values().to_numpy()
        at = [p * (len(values) - 1) for p in probs] if len(values) else []
        assert got[c] == [a if a == b else a + (b - a) * (x - int(x)) for x in at for a, b in [(values[int(x)], values[int(np.ceil(x))])]], c
    for c in ("money", "days", "few"):
        assert np.allclose(got[c], frame[c].quantile(probs), rtol=1e-12)
    assert got["none"] == []
