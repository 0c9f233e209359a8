"""Invariants over the supplied tables and model sanity (§5.4)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartlens.operators import quality as dq
from cartlens.operators import repair
from cartlens.plans import campaign, sentiment
from cartlens.plans.etl import shop_clean, shop_raw

from conftest import SMALL

Q = entry.queries()


def test_segment_counts_sum_to_users(spark):
    total = Q["rfm_segment_counts"](spark, SMALL).agg(F.sum("num_users")).first()[0]
    assert total == Q["rfm_base"](spark, SMALL).count()
    assert Q["rfm_segments"](spark, SMALL).where(F.col("segment").isNull() | F.col("recency").isNull()).count() == 0


def test_repairs_leave_nothing_to_find_and_are_idempotent(spark):
    t = shop_clean(spark, SMALL)
    assert dq.fk_violation_count(t["orders"], t["users"], "user_uid", "user_uid").first()[0] == 0
    assert dq.fk_violation_count(t["order_details"], t["orders"], "order_uid", "order_uid").first()[0] == 0
    assert dq.numeric_range(t["order_details"], "item_amount").first().negative == 0
    again = repair.fk_strict(t["orders"], t["users"], "user_uid", "user_uid")
    assert again.count() == t["orders"].count()
    assert dq.duplicate_keys(t["cards"], "card_uid").count() == 0


def test_raw_tables_do_have_dirt(spark):
    raw = shop_raw(spark, SMALL)
    users = shop_clean(spark, SMALL)["users"]
    assert dq.fk_violation_count(raw["orders"], users, "user_uid", "user_uid").first()[0] > 0


def test_churn_labels_match_cutoff(spark):
    labels = Q["churn_labels"](spark, SMALL)
    kpi = Q["order_kpi"](spark, SMALL)
    t0 = kpi.agg(F.max("order_date") - F.expr("INTERVAL 90 DAYS")).first()[0]
    bad = labels.where((F.col("churned") == 1) != (F.col("last_order_date") < F.lit(t0)))
    assert bad.count() == 0


def test_one_hot_one_row_per_user_and_feature(spark):
    oh = Q["one_hot"](spark, SMALL)
    users = Q["churn_features"](spark, SMALL).count()
    assert oh.count() == users * 5
    assert oh.where(F.col("level").isNull()).count() == 0


def test_tfidf_rows_have_unit_norm(spark):
    w = Q["tfidf"](spark, SMALL)
    norms = w.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n"))
    assert norms.where(F.abs(F.col("n") - 1) > 1e-6).count() == 0


def test_split_proportion(spark):
    s = Q["stratified_split"](spark, "/root/testdata/sf0.01")
    frac = s.agg(F.avg(F.col("is_test").cast("double"))).first()[0]
    assert 0.25 < frac < 0.35


def test_models_give_probabilities(spark):
    data = campaign.churn_data(shop_clean(spark, SMALL), user_columns=["user_uid", "source", "language"])
    scored, auc = campaign.evaluate(data, "lr")
    assert scored.where((F.col("churn_proba") < 0) | (F.col("churn_proba") > 1)).count() == 0
    assert 0 <= auc.first()["auc"] <= 1


def test_sentiment_learns_its_classes(spark):
    rows = [(i, f"word{i % 4} common text number {i % 4} again", ["bad", "fine", "good", "mixed"][i % 4]) for i in range(80)]
    raw = spark.createDataFrame(rows, "labelled_review_uid long, text string, sentiment_label string")
    r = sentiment.train_sentiment(raw)
    assert r.classes == ["bad", "fine", "good", "mixed"]
    assert r.test_predictions.where("sentiment_label <> sentiment_pred").count() == 0
    more = spark.createDataFrame([(1, 7, "word2 common"), (2, None, None), (3, 8, "zzz")], "review_uid long, user_uid long, text string")
    scored = {x.review_uid: x.sentiment_pred for x in sentiment.score_reviews(more, r).collect()}
    assert scored[1] == "good" and set(scored.values()) <= set(r.classes) and len(scored) == 3
    plan = sentiment.score_reviews(more, r)._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_exact_split_quota_per_class(spark):
    s = Q["stratified_split_exact"](spark, SMALL)
    per = {r.churned: (r.n, r.t) for r in s.groupBy("churned").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    for n, t in per.values():
        assert t == int(0.3 * n + 0.5)


def test_term_counts_travel_packed(spark):
    """A term moves once per part of the documents, not once per document; keys may repeat or be null."""
    from collections import Counter
    from math import log, sqrt

    from pyspark.sql import functions as F

    from cartlens.operators import sentiment as sn
    rows = [(i % 90 if i % 50 else None, f"common words word{i % 7} common extra{i}", i % 3 > 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "id long, text string, train boolean")
    posts = sn.postings(docs, "id", "text", "train").cache()
    parts = sn.PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert posts.where("term = 'common'").count() <= parts and sn.postings(docs, "id", "text")._jdf.queryExecution().toString().count("Exchange") <= 4
    counts = Counter((i, train, t) for i, text, train in rows for w in [text.split()] for t in [*w, *map(" ".join, zip(w, w[1:]))])
    df = Counter(t for i, train, t in counts if train)
    vocab = sn.vocabulary(posts, spark.createDataFrame([(200,)], "n long"), 2, 0.95)
    want = {t: (n, log(201 / (1 + n)) + 1) for t, n in df.items() if 2 <= n <= 190}
    got = {r.term: (r.df, r.idf) for r in vocab.collect()}
    assert got.keys() == want.keys() and all(got[t] == pytest.approx(want[t]) for t in want)
    raw = [(i, t, (1 + log(n)) * want[t][1]) for (i, _, t), n in counts.items() if t in want]
    norm = Counter()
    for i, _, x in raw:
        norm[i] += x * x
    out = Counter((r.id, r.term, round(r.weight, 9)) for r in sn.tfidf(posts, vocab, "id").select("id", "term", F.col("weight")).collect())
    assert out == Counter((i, t, round(x / sqrt(norm[i]), 9)) for i, t, x in raw)
    posts.unpersist()
