"""Operator semantics on literal frames (FIXTURES.md edge cases, SURVEY §5)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cartlens.operators import breakdowns as bd
from cartlens.operators import campaign, features, kpi, models, quality, repair, rfm, stats
from cartlens.operators import sentiment as sn


def test_latest_per_key_null_date_wins(spark):
    df = spark.createDataFrame([("c1", dt.datetime(2020, 1, 2), 1), ("c1", None, 2), ("c2", dt.datetime(2020, 1, 1), 3),
                                ("c2", dt.datetime(2020, 1, 1), 4), (None, None, 5)],
                               "card_uid string, assigned_at timestamp_ntz, event_id int")
    out = {r.card_uid: r.event_id for r in repair.latest_per_key(df, "card_uid", "assigned_at", "event_id").collect()}
    assert out == {"c1": 2, "c2": 4}


def test_quintile_breaks_and_scores(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 10])], "i int, x double")
    b = df.agg(stats.percentiles("x", [0.2, 0.4, 0.6, 0.8]).alias("b")).first().b
    assert [round(v, 6) for v in b] == [1.8, 2.6, 3.4, 5.2]
    s = stats.with_scalars(df, df.agg(stats.percentiles("x", [0.2, 0.4, 0.6, 0.8]).alias("b")))
    got = [r[0] for r in s.orderBy("i").select(rfm.quintile_score(F.col("x"), F.col("b"), True)).collect()]
    assert got == [5, 4, 3, 2, 1]


def test_distributed_quantiles_match_exact(spark):
    rng = random.Random(7)
    vals = [rng.choice([5.0, 5.0, 5.0, rng.uniform(0, 100)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.1, 0.5, 0.77, 0.99]
    exact = df.agg(stats.percentiles("x", probs).alias("q")).first().q
    dist = stats.distributed_quantiles(df, "x", probs, buckets=16).first().q
    assert [round(a, 9) for a in exact] == [round(b, 9) for b in dist]


def test_ordered_prefix_matches_running_sum(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(500)], "s double, n long")
    out = stats.ordered_prefix(df, "s", ["n"], buckets=8).orderBy("s").collect()
    run = 0
    for r in out:
        assert r.n_before == run
        run += r.n


def test_day_span_is_whole_days(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 23), dt.datetime(2020, 1, 3, 1))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(F.timestamp_diff("DAY", "a", "b")).first()[0] == 1


def test_monthly_volume_fills_gaps(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 5),), (dt.datetime(2020, 3, 31),), (dt.datetime(2020, 3, 31),)],
                               "created_at timestamp_ntz")
    out = [(r.period_end.date(), r.num_orders) for r in bd.order_volume(df, "created_at").orderBy("period_end").collect()]
    assert out == [(dt.date(2020, 1, 31), 1), (dt.date(2020, 2, 29), 0), (dt.date(2020, 3, 31), 2)]


def test_first_non_null_columns_independent(spark):
    df = spark.createDataFrame([("u", 1, None, "q"), ("u", 2, "z", None), ("u", 3, "y", "r")],
                               "user_uid string, ord int, a string, b string")
    r = kpi.first_non_null_per_key(df, "user_uid", ["a", "b"], "ord").first()
    assert (r.a, r.b) == ("z", "q")


def test_age_floor(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 1, 1),), (dt.datetime(2025, 6, 1),)], "birthday timestamp_ntz")
    assert [r.age for r in bd.with_age(df, "2024-01-01").collect()] == [24, -2]


def test_population_std(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0)], "k int, x double")
    z = [r.x for r in features.standardize(df, ["x"]).orderBy("k").collect()]
    mu, sd = 7 / 3, 1.247219128924647
    assert [round(v, 9) for v in z] == [round((x - mu) / sd, 9) for x in (1, 2, 4)]
    const = spark.createDataFrame([(1, 3.0), (2, 3.0)], "k int, x double")
    assert [r.x for r in features.standardize(const, ["x"]).collect()] == [0.0, 0.0]


def test_roc_auc_matches_pairwise(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), float(rng.randint(0, 20))) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = features.roc_auc(df, "y", "s", buckets=4).first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_dense_index_contiguous_sorted(spark):
    words = [f"w{i:04d}" for i in range(300)]
    df = spark.createDataFrame([(w,) for w in words * 2], "term string")
    out = sn.dense_index(df, "term").orderBy("idx").collect()
    assert [r.idx for r in out] == list(range(300))
    assert [r.term for r in out] == sorted(words)


def test_ngrams(spark):
    df = spark.createDataFrame([(1, "the cat sat"), (2, "a"), (3, "")], "id int, text string")
    out = {r.id: r.t for r in df.select("id", sn.ngrams_1_2(sn.tokens(F.col("text"))).alias("t")).collect()}
    assert out == {1: ["the", "cat", "sat", "the cat", "cat sat"], 2: [], 3: []}


def test_fk_repairs_keep_and_drop_nulls(spark):
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "user_uid string")
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, user_uid string")
    keep = sorted(r.id for r in repair.fk_keep_null(child, parent, "user_uid", "user_uid").collect())
    strict = sorted(r.id for r in repair.fk_strict(child, parent, "user_uid", "user_uid").collect())
    assert keep == [1, 3] and strict == [1]


def test_fit_statistics_on_training_rows_only(spark):
    df = spark.createDataFrame([(1, 1.0, False), (2, None, False), (3, 100.0, True)],
                               "k int, x double, is_test boolean")
    all_rows = {r.k: r.x for r in features.impute_median(df, ["x"]).collect()}
    train = {r.k: r.x for r in features.impute_median(df, ["x"], fit_rows=~F.col("is_test")).collect()}
    assert all_rows[2] == 50.5 and train[2] == 1.0
    z = {r.k: r.x for r in features.standardize(df.fillna(1.0), ["x"], fit_rows=~F.col("is_test")).collect()}
    assert z[1] == 0.0 and z[3] == 99.0


def test_customer_orders_null_safe_option(spark):
    orders = spark.createDataFrame([(1, None), (2, 7)], "order_uid int, user_uid int")
    users = spark.createDataFrame([(None, "x"), (7, "y")], "user_uid int, city string")
    plain = {r.order_uid: r.city for r in kpi.customer_orders(orders, users).collect()}
    safe = {r.order_uid: r.city for r in kpi.customer_orders(orders, users, null_safe=True).collect()}
    assert plain == {1: None, 2: "y"} and safe == {1: "x", 2: "y"}


def test_keep_where_matches_where(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, "ab"), (3, None), (4, "xxxxx")], "id int, text string")
    got = repair.keep_where(df, "text", lambda t: F.length(t) > 3)
    assert got.columns == ["id", "text"]
    assert sorted(got.collect()) == sorted(df.where(F.length("text") > 3).collect())


def test_order_volume_week_and_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 3),), (dt.datetime(2024, 1, 10),)],
                               "created_at timestamp_ntz")
    days = [(r.period_end.date(), r.num_orders) for r in bd.order_volume(df, "created_at", "day").orderBy("period_end").collect()]
    assert len(days) == 10 and days[0] == (dt.date(2024, 1, 1), 1) and days[1][1] == 0 and days[-1][1] == 1
    weeks = [r.num_orders for r in bd.order_volume(df, "created_at", "week").orderBy("period_end").collect()]
    assert weeks == [2, 1]


def test_exact_split_three_classes(spark):
    rows = [(i, ["a", "b", "c"][i % 3] if i % 7 else "c") for i in range(600)]
    df = spark.createDataFrame(rows, "k int, y string")
    out = features.exact_split_flag(df, "k", "y", 0.25, 42)
    per = {r.y: (r.n, r.t) for r in out.groupBy("y").agg(F.count(F.lit(1)).alias("n"),
                                                           F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert all(t == int(0.25 * n + 0.5) for n, t in per.values())
    assert out.count() == 600


def test_exact_split_many_classes_and_null(spark):
    rows = [(i, None if i % 301 == 0 else f"c{i % 300}") for i in range(3000)]
    out = features.exact_split_flag(spark.createDataFrame(rows, "k int, y string"), "k", "y", 0.3, 42)
    per = {r.y: (r.n, r.t) for r in out.groupBy("y").agg(F.count(F.lit(1)).alias("n"),
                                                           F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert len(per) == 301 and None in per
    assert all(t == int(0.3 * n + 0.5) for n, t in per.values())


def test_money_sum_small_nan_and_null_amounts(spark):
    rows = [("small", 0.004)] * 100 + [("nan", float("nan")), ("nan", 1.5), ("null", None), ("mixed", None), ("mixed", 2.25)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.s for r in df.groupBy("g").agg(stats.money_sum("x").alias("s")).collect()}
    assert abs(got.pop("small") - 0.4) < 1e-12
    assert got == {"nan": 1.5, "null": 0.0, "mixed": 2.25}


def test_dense_index_without_exchange_reuse(spark):
    df = spark.range(60_000).select(F.concat(F.lit("t"), F.md5(F.col("id").cast("string"))).alias("term"))
    old = spark.conf.get("spark.sql.exchange.reuse", "true")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = sn.dense_index(df, "term")
        r = out.agg(F.countDistinct("idx").alias("n"), F.min("idx").alias("a"), F.max("idx").alias("b")).first()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
    assert (r.n, r.a, r.b) == (60_000, 0, 59_999)


def test_quantiles_of_nothing_are_null(spark):
    for df in (spark.createDataFrame([], "k int, x double, monetary_total double, churn_proba double"),
               spark.createDataFrame([(1, None, None, 0.9)], "k int, x double, monetary_total double, churn_proba double")):
        assert stats.distributed_quantiles(df, "x", [0.5]).first().q == []
        assert all(r.x is None for r in features.impute_median(df, ["x"], unbounded=["x"]).collect())
        assert campaign.select_targets(df, "churn_proba").collect() == []
    empty = spark.createDataFrame([], "order_uid int, user_uid int, order_date timestamp_ntz, order_revenue double")
    assert rfm.rfm_segments(empty).collect() == []


def test_foreign_keys_in_one_pass(spark):
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "user_uid string")
    child = spark.createDataFrame([(1, "a", "x"), (2, "z", "x"), (3, None, "x"), (4, None, "free"), (5, "z", "free"), (6, "b", None), (6, "b", None)],
                                  "id int, user_uid string, status string")
    assert quality.fk_violation_count(child, parent, "user_uid", "user_uid").first()[0] == 4
    assert quality.conditional_fk_count(child, parent, "user_uid", "user_uid", "status", "free").first()[0] == 2
    kept = repair.fk_conditional(child, parent, "user_uid", "user_uid", "status", "free")
    assert kept.columns == child.columns and sorted(r.id for r in kept.collect()) == [1, 4, 5, 6, 6]
    assert sorted(r.id for r in repair.fk_keep_null(child, parent, "user_uid", "user_uid").collect()) == [1, 3, 4, 6, 6]


def test_design_vector_has_one_entry_per_level(spark):
    df = spark.createDataFrame([(1, 0.5, "x"), (2, 1.5, "y"), (3, 2.5, "x")], "k int, n double, c string")
    out, _ = models.design_matrix(df, ["n"], ["c"])
    assert [list(r.features.toArray()) for r in out.orderBy("k").collect()] == [[0.5, 1, 0], [1.5, 0, 1], [2.5, 1, 0]]
