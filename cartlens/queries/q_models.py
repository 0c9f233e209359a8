"""Registered queries for features, metrics, text features and models (I, J, K).

Everything around the model fits (imputation, scaling, one-hot, split, AUC,
reports, TF-IDF) is compared row by row. The fits themselves are not compared
with another library: their keys return what SQL can state about them (which
rows are scored, that probabilities and classes are in range, that decisions
follow the rule, that the penalised loss has gradient zero).
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartlens.catalog import register
from cartlens.oracles.views import sql, strip
from cartlens.operators import campaign, features, forest
from cartlens.operators import sentiment as sn
from cartlens.operators.features import threshold_hex
from cartlens.operators.stats import with_scalars
from cartlens.plans import campaign as camp_plan
from cartlens.plans import sentiment as sent_plan
from cartlens.plans.etl import shop_clean
from cartlens.queries.common import churn_features_of as _features
from cartlens.queries.q_text import sql_normalize_ws, sql_review_clean
from cartlens.schema import (CHURN_NUMERIC, CHURN_PROB_THRESHOLD, CHURN_TEST_FRACTION, SEED,
                             SENTIMENT_TEST_FRACTION)
from cartlens.session import cut_lineage
from cartlens.sources import shop_tables as st

NUM = CHURN_NUMERIC
CAT = ["source", "language", "sex", "level", "main_city"]


def _num_sql(fn) -> str:
    return ", ".join(fn(c) for c in NUM)


# ------------------------------------------------------------ I: features

@register("impute_median", sql(f"""
SELECT user_uid, {_num_sql(lambda c: f'coalesce(CAST({c} AS DOUBLE), median(CAST({c} AS DOUBLE)) OVER ()) AS {c}')}
FROM churn_features""", "churn_features"), money=("monetary_total", "avg_order_value",))
def q_impute_median(spark, sf):
    f = _features(spark, sf).select("user_uid", *NUM)
    return features.impute_median(f, NUM)


def _std_sql(c: str) -> str:
    x = f"coalesce(CAST({c} AS DOUBLE), median(CAST({c} AS DOUBLE)) OVER ())"
    return x


@register("standardize", sql(f"""
WITH imp AS (SELECT user_uid, {_num_sql(lambda c: f'{_std_sql(c)} AS {c}')} FROM churn_features)
SELECT user_uid, {_num_sql(lambda c: f'''round(({c} - avg({c}) OVER ()) /
  CASE WHEN stddev_pop({c}) OVER () IS NULL OR stddev_pop({c}) OVER () = 0 THEN 1.0
       ELSE stddev_pop({c}) OVER () END, 6) AS {c}''')}
FROM imp""", "churn_features"))
def q_standardize(spark, sf):
    f = _features(spark, sf).select("user_uid", *NUM)
    s = features.standardize(features.impute_median(f, NUM), NUM)
    return s.select("user_uid", *[F.round(c, 6).alias(c) for c in NUM])


@register("one_hot", sql("\nUNION ALL\n".join(
    f"SELECT user_uid, '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'Missing') AS level, "
    f"'{c}_' || coalesce(CAST({c} AS VARCHAR), 'Missing') AS dummy FROM churn_features" for c in CAT),
    "churn_features"))
def q_one_hot(spark, sf):
    return features.one_hot_long(_features(spark, sf), "user_uid", CAT)


@register("stratified_split", sql(f"""
SELECT user_uid, churned,
       substr(md5(CAST(user_uid AS VARCHAR) || ':{SEED}'), 1, 8) < '{threshold_hex(CHURN_TEST_FRACTION)}' AS is_test
FROM churn_features""", "churn_features"))
def q_stratified_split(spark, sf):
    f = _features(spark, sf).select("user_uid", "churned")
    return features.split_flag(f, "user_uid", CHURN_TEST_FRACTION, SEED)


@register("stratified_split_exact", sql(f"""
SELECT user_uid, churned,
       row_number() OVER (PARTITION BY churned
                          ORDER BY substr(md5(CAST(user_uid AS VARCHAR) || ':{SEED}'), 1, 14)) - 1
         < floor({CHURN_TEST_FRACTION} * count(*) OVER (PARTITION BY churned) + 0.5) AS is_test
FROM churn_features""", "churn_features"))
def q_stratified_split_exact(spark, sf):
    f = _features(spark, sf).select("user_uid", "churned")
    return features.exact_split_flag(f, "user_uid", "churned", CHURN_TEST_FRACTION, SEED)


@register("target_distribution", sql("""
SELECT churned, count(*) AS num_users FROM churn_features GROUP BY churned""", "churn_features"))
def q_target_distribution(spark, sf):
    """I8: rows per target value in the design table."""
    f = _features(spark, sf)
    return f.groupBy("churned").agg(F.count(F.lit(1)).alias("num_users"))


_INACTIVE = "tenure_days - date_sub('day', first_order_date, last_order_before_T0)"


def _inactive_days():
    return F.col("tenure_days") - F.timestamp_diff("DAY", F.col("first_order_date"), F.col("last_order_before_T0"))


def _auc_sql(score: str, name: str) -> str:
    return f"""
SELECT '{name}' AS score_name, round(sum(pos * (CAST(nb AS DOUBLE) + neg * CAST(0.5 AS DOUBLE)))
                               / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 9) AS auc
FROM (SELECT s, pos, neg,
             coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM (SELECT CAST({score} AS DOUBLE) AS s, count(*) FILTER (WHERE churned = 1) AS pos,
                   count(*) FILTER (WHERE churned <> 1) AS neg
            FROM churn_features WHERE {score} IS NOT NULL GROUP BY 1))"""


@register("roc_auc", sql(_auc_sql(_INACTIVE, "inactive_days") + "\nUNION ALL\n" + _auc_sql("freq_total", "freq_total"),
                         "churn_features"))
def q_roc_auc(spark, sf):
    f = cut_lineage(_features(spark, sf).withColumn("inactive_days", _inactive_days()))
    parts = [features.roc_auc(f, "churned", s).select(F.lit(s).alias("score_name"), F.round("auc", 9).alias("auc"))
             for s in ("inactive_days", "freq_total")]
    return parts[0].unionByName(parts[1])


_RULE_PRED = "CASE WHEN orders_last_30d = 0 THEN 1 ELSE 0 END"


def _rule_pred(df):
    return df.withColumn("prediction", F.when(F.col("orders_last_30d") == 0, 1).otherwise(0))


@register("classification_report", sql(f"""
WITH p AS (SELECT CAST(churned AS VARCHAR) AS label, CAST({_RULE_PRED} AS VARCHAR) AS pred FROM churn_features),
cls AS (SELECT label AS cls FROM p UNION SELECT pred FROM p),
per AS (SELECT c.cls,
               (SELECT count(*) FROM p WHERE label = c.cls) AS support,
               (SELECT count(*) FROM p WHERE pred = c.cls) AS predicted,
               (SELECT count(*) FROM p WHERE label = c.cls AND pred = c.cls) AS tp FROM cls c),
m AS (SELECT cls, support, tp,
             CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
m2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE 0.0 END AS f1 FROM m)
SELECT cls AS class_name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       support FROM m2
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                 CAST(sum(support) AS BIGINT) FROM m2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                 round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                 CAST(sum(support) AS BIGINT) FROM m2""", "churn_features"))
def q_classification_report(spark, sf):
    return features.classification_report(_rule_pred(_features(spark, sf)), "churned", "prediction")


@register("confusion_matrix", sql(f"""
SELECT CAST(churned AS VARCHAR) AS label,
       count(*) FILTER (WHERE {_RULE_PRED} = 0) AS pred_0, count(*) FILTER (WHERE {_RULE_PRED} = 1) AS pred_1
FROM churn_features GROUP BY churned""", "churn_features"))
def q_confusion_matrix(spark, sf):
    return features.confusion_matrix(_rule_pred(_features(spark, sf)), "churned", "prediction", ["0", "1"])


# ------------------------------------------------------------------ J: text

_LAB = f"""
WITH lab AS (
  SELECT id, text, sentiment_label,
         row_number() OVER (PARTITION BY sentiment_label ORDER BY substr(md5(CAST(id AS VARCHAR) || ':{SEED}'), 1, 14)) - 1
           < floor({SENTIMENT_TEST_FRACTION} * count(*) OVER (PARTITION BY sentiment_label) + 0.5) AS is_test
  FROM (SELECT labelled_review_uid AS id, {sql_review_clean(sql_normalize_ws('text'))} AS text,
               lower({strip('sentiment_label')}) AS sentiment_label FROM raw_labelled)
  WHERE length(text) > 3),
tk AS (SELECT id, is_test, regexp_extract_all(lower(text), '\\b\\w\\w+\\b') AS t FROM lab),
counts AS (SELECT id, is_test, term, count(*) AS tf FROM (
  SELECT id, is_test, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM tk) GROUP BY id, is_test, term),
ntrain AS (SELECT count(*) AS n FROM lab WHERE NOT is_test),
vocab AS (SELECT term, df, ln((1 + n) / (1 + df)) + 1 AS idf
          FROM (SELECT term, count(*) AS df FROM counts WHERE NOT is_test GROUP BY term), ntrain
          WHERE df >= 2 AND df <= n * CAST(0.95 AS DOUBLE))
"""


def _lab_sql(body: str) -> str:
    return sql(_LAB + body, "raw_labelled")


def _docs(spark, sf):
    return sent_plan.labelled_docs(st.raw_reviews_labelled(spark, sf))


@register("sentiment_split", _lab_sql("SELECT id, sentiment_label, is_test FROM lab"))
def q_sentiment_split(spark, sf):
    """Labelled training projection with its 80/20 split flag."""
    return _docs(spark, sf).select("id", "sentiment_label", "is_test")


@register("tokenize", _lab_sql("""
SELECT id, len(t) AS num_tokens, array_to_string(t, ' ') AS tokens FROM tk"""))
def q_tokenize(spark, sf):
    d = _docs(spark, sf)
    t = sn.tokens(F.col("text"))
    return d.select("id", F.size(t).alias("num_tokens"), F.array_join(t, " ").alias("tokens"))


@register("ngrams_1_2", _lab_sql("SELECT id, term, tf FROM counts"))
def q_ngrams(spark, sf):
    return sn.term_counts(_docs(spark, sf), "id", "text")


@register("vocabulary", _lab_sql("SELECT term, df, round(idf, 9) AS idf FROM vocab"))
def q_vocabulary(spark, sf):
    tf = sent_plan.fit_text_features(_docs(spark, sf))
    return tf.vocab.select("term", "df", F.round("idf", 9).alias("idf"))


@register("tfidf", _lab_sql("""
SELECT id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)), 9) AS weight
FROM (SELECT c.id, c.term, (1 + ln(c.tf)) * v.idf AS raw FROM counts c JOIN vocab v ON c.term = v.term)"""))
def q_tfidf(spark, sf):
    d = _docs(spark, sf)
    posts = sent_plan.doc_postings(d)
    tf = sent_plan.fit_text_features(d, posts)
    w = sn.tfidf(posts, tf.vocab, "id")
    return w.select("id", "term", F.round("weight", 9).alias("weight"))


@register("term_index", _lab_sql("""
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM vocab"""))
def q_term_index(spark, sf):
    return sn.dense_index(sent_plan.fit_text_features(_docs(spark, sf)).vocab, "term")


@register("class_weights", _lab_sql("""
SELECT sentiment_label, round(n / (k * n_c), 9) AS weight
FROM (SELECT sentiment_label, count(*) AS n_c FROM lab WHERE NOT is_test GROUP BY sentiment_label),
     (SELECT count(*) AS n, count(DISTINCT sentiment_label) AS k FROM lab WHERE NOT is_test)"""))
def q_class_weights(spark, sf):
    d = _docs(spark, sf).where(~F.col("is_test"))
    return sn.class_weights(d, "sentiment_label").select("sentiment_label", F.round("weight", 9).alias("weight"))


def _trained(spark, sf):
    return sent_plan.train_sentiment(st.raw_reviews_labelled(spark, sf))


@register("sentiment_lr", _lab_sql("""
SELECT id, sentiment_label, true AS pred_is_class FROM lab WHERE is_test"""))
def q_sentiment_lr(spark, sf):
    """The class-weighted multinomial model labels each hold-out row with a learned class."""
    r = _trained(spark, sf)
    return r.test_predictions.select("id", "sentiment_label",
                                     F.coalesce(F.col("sentiment_pred").isin(r.classes), F.lit(False)).alias("pred_is_class"))


@register("sentiment_lr_gradient", _lab_sql("""
SELECT DISTINCT sentiment_label, CAST(0 AS DOUBLE) AS max_abs_gradient FROM lab"""))
def q_sentiment_lr_gradient(spark, sf):
    """The model is an optimum: the largest gradient over all terms is zero to 3 places."""
    g = sent_plan.multinomial_gradient(_trained(spark, sf))
    return g.select("sentiment_label", F.round("max_abs_gradient", 3).alias("max_abs_gradient"))


@register("sentiment_confusion_matrix", _lab_sql("""
SELECT sentiment_label AS label, count(*) AS num_docs FROM lab WHERE is_test GROUP BY sentiment_label"""))
def q_sentiment_confusion(spark, sf):
    """The confusion matrix's rows add up to the hold-out rows of each class."""
    m = _trained(spark, sf).confusion
    return m.select("label", sum((F.col(c) for c in m.columns[1:]), F.lit(0)).cast("long").alias("num_docs"))


@register("sentiment_report", _lab_sql("""
SELECT sentiment_label AS class_name, count(*) AS support, true AS in_unit FROM lab WHERE is_test GROUP BY sentiment_label
UNION ALL SELECT unnest(['accuracy', 'macro avg', 'weighted avg']), (SELECT count(*) FROM lab WHERE is_test), true"""))
def q_sentiment_report(spark, sf):
    """Supports of the sentiment report; its scores lie between 0 and 1."""
    r = _trained(spark, sf).report.where("support > 0")
    ok = [F.coalesce(F.col(c).between(0, 1), F.lit(True)) for c in ("precision", "recall", "f1")]
    return r.select("class_name", "support", (ok[0] & ok[1] & ok[2]).alias("in_unit"))


@register("sentiment_scored", sql(f"""
SELECT review_uid, user_uid, {sql_review_clean(sql_normalize_ws('text'))} AS text, true AS pred_is_class
FROM raw_reviews""", "raw_reviews"))
def q_sentiment_scored(spark, sf):
    """Every review gets a learned class; its other columns are compared."""
    r = _trained(spark, sf)
    scored = sent_plan.score_reviews(st.raw_reviews(spark, sf), r)
    return scored.select("review_uid", "user_uid", "text",
                         F.coalesce(F.col("sentiment_pred").isin(r.classes), F.lit(False)).alias("pred_is_class"))


@register("sentiment_predictions")
def q_sentiment_predictions(spark, sf):
    """The class of every review (tests repeat the scoring join in SQL from the coefficient table)."""
    return sent_plan.score_reviews(st.raw_reviews(spark, sf), _trained(spark, sf)).select("review_uid", "sentiment_pred")


@register("sentiment_coefficients")
def q_sentiment_coefficients(spark, sf):
    """The model as a table: term, class and coefficient (``sentiment_lr_gradient`` proves the optimum)."""
    r = _trained(spark, sf)
    names = F.array(*[F.lit(c) for c in r.classes])
    return (r.model.coefficients.select("term", F.posexplode("coef").alias("pos", "coefficient"))
            .select("term", F.get(names, F.col("pos")).alias("sentiment_label"), F.round("coefficient", 2).alias("coefficient")))


# ---------------------------------------------------------- I/K: models

def _churn_data(spark, sf):
    return camp_plan.churn_data(shop_clean(spark, sf), user_columns=["user_uid", "source", "language"])


_HOLD_OUT = f"""
h AS (SELECT user_uid, churned,
             row_number() OVER (PARTITION BY churned ORDER BY substr(md5(CAST(user_uid AS VARCHAR) || ':{SEED}'), 1, 14)) - 1
               < floor({CHURN_TEST_FRACTION} * count(*) OVER (PARTITION BY churned) + 0.5) AS is_test
      FROM churn_features)"""
_LEVELS = f"""
lv AS (SELECT f, level, CAST(row_number() OVER (ORDER BY f, level) + {len(NUM)} - 1 AS INTEGER) AS pos
       FROM ({" UNION ".join(f"SELECT {i} AS f, coalesce(CAST({c} AS VARCHAR), 'Missing') AS level FROM churn_features" for i, c in enumerate(CAT))}))"""


_DESIGN = f"""
imp AS (SELECT user_uid, {_num_sql(lambda c: f'{_std_sql(c)} AS {c}')} FROM churn_features),
{_LEVELS},
dm AS (
{" UNION ALL ".join(f"""SELECT user_uid, {i} AS pos, ({c} - avg({c}) OVER ()) /
  CASE WHEN stddev_pop({c}) OVER () IS NULL OR stddev_pop({c}) OVER () = 0 THEN 1.0 ELSE stddev_pop({c}) OVER () END AS value FROM imp"""
  for i, c in enumerate(NUM))}
UNION ALL
SELECT user_uid, pos, CASE WHEN lv.level = CASE f {" ".join(f"WHEN {i} THEN coalesce(CAST(u.{c} AS VARCHAR), 'Missing')" for i, c in enumerate(CAT))} END
                           THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
FROM churn_features u CROSS JOIN lv)"""


@register("design_matrix", sql(f"WITH {_DESIGN} SELECT user_uid, pos, round(value, 6) AS value FROM dm", "churn_features"))
def q_design_matrix(spark, sf):
    """The design vector, entry by entry: scaled numerics, then one column per level."""
    d = _churn_data(spark, sf).design
    return (d.select("user_uid", F.posexplode(vector_to_array(F.col("features"))).alias("pos", "value"))
            .withColumn("value", F.round("value", 6)))


def _holdout_facts(scored):
    p = F.col("churn_proba")
    return scored.select("user_uid", "churned", F.coalesce(p.between(0, 1), F.lit(False)).alias("proba_in_unit"),
                         ((F.col("prediction") == 1) == (p >= 0.5)).alias("prediction_is_threshold"))


_FACTS_SQL = sql(f"""
WITH {_HOLD_OUT}
SELECT user_uid, churned, true AS proba_in_unit, true AS prediction_is_threshold FROM h WHERE is_test""", "churn_features")


@register("churn_lr", _FACTS_SQL)
def q_churn_lr(spark, sf):
    """Logistic regression scores exactly the hold-out rows."""
    return _holdout_facts(camp_plan.evaluate(_churn_data(spark, sf), "lr")[0])


@register("churn_lr_gradient", sql(f"""
WITH {_LEVELS}
SELECT CAST(unnest(range(0, {len(NUM)} + (SELECT count(*) FROM lv))) AS INTEGER) AS pos, CAST(0 AS DOUBLE) AS gradient""",
                                   "churn_features"))
def q_churn_lr_gradient(spark, sf):
    """The logistic model is an optimum: each coefficient's gradient is zero to 3 places."""
    g = camp_plan.lr_gradient(_churn_data(spark, sf))
    return g.select("pos", F.abs(F.round("gradient", 3)).alias("gradient"))


@register("churn_rf", _FACTS_SQL)
def q_churn_rf(spark, sf):
    """The random forest scores exactly the hold-out rows."""
    return _holdout_facts(camp_plan.evaluate(_churn_data(spark, sf), "rf")[0])


@register("model_comparison", "SELECT unnest(['lr', 'rf']) AS model, true AS auc_in_unit")
def q_model_comparison(spark, sf):
    """One hold-out AUC per model, between 0 and 1."""
    data = _churn_data(spark, sf)
    both = camp_plan.evaluate(data, "lr")[1].unionByName(camp_plan.evaluate(data, "rf")[1])
    return both.select("model", F.coalesce(F.col("auc").between(0, 1), F.lit(False)).alias("auc_in_unit"))


@register("churn_rf_scores")
def q_churn_rf_scores(spark, sf):
    """Hold-out probabilities of the exact forest (tests grow it by brute force)."""
    return camp_plan.evaluate(_churn_data(spark, sf), "rf")[0]


@register("churn_lr_scores")
def q_churn_lr_scores(spark, sf):
    """Hold-out probabilities of the logistic model (``churn_lr_gradient`` proves the optimum)."""
    return camp_plan.evaluate(_churn_data(spark, sf), "lr")[0]


@register("model_auc")
def q_model_auc(spark, sf):
    """The hold-out AUC of each model (tests recompute it in SQL from the scores)."""
    data = _churn_data(spark, sf)
    return camp_plan.evaluate(data, "lr")[1].unionByName(camp_plan.evaluate(data, "rf")[1])


@register("campaign_scores")
def q_campaign_scores(spark, sf):
    """I16, K1: every user's probability by the forest refitted on all rows."""
    return camp_plan.run_campaign(shop_clean(spark, sf), evaluate_holdout=False)["scored"].select(
        "user_uid", "churned", "monetary_total", "churn_proba")


#: Trees whose first cut is compared, and design columns whose drawn order the SQL lists.
ROOT_TREES, ROOT_COLUMNS = 12, 256


def _roots_sql() -> str:
    every = np.ones((1, ROOT_COLUMNS), bool)
    cuts, orders = [], []
    for t in range(ROOT_TREES):
        a, b = forest.multipliers(t, SEED)
        cuts.append(f"({t}, {a}, {b})")
        for k in range(ROOT_COLUMNS):  # the k-th drawn column is what the first k + 1 have more than the first k
            got = set(forest.candidates(np.array([forest.root(t, SEED)]), every, k + 1)[0].tolist())
            orders += [f"({t}, {k}, {c})" for c in got - (set() if not k else before)]
            before = got
    weight = f"list_sum([CAST((hh * a + b) % {2**31 - 1} >= c AS INTEGER) for c in {forest.WEIGHT_CUTS}])"
    return sql(f"""
WITH {_HOLD_OUT}, {_DESIGN},
t(tree, a, b) AS (VALUES {", ".join(cuts)}),
o(tree, k, pos) AS (VALUES {", ".join(orders)}),
w AS (SELECT tree, user_uid, y, w FROM (
    SELECT tree, user_uid, y, {weight} AS w FROM t CROSS JOIN (
      SELECT user_uid, churned AS y, ('0x' || substr(md5(CAST(user_uid AS VARCHAR)), 1, 15))::BIGINT % {2**31 - 1} AS hh FROM h WHERE NOT is_test))
  WHERE w > 0),
varies AS (SELECT tree, pos FROM w JOIN dm USING (user_uid) GROUP BY tree, pos HAVING min(value) < max(value)),
tried AS (SELECT tree, pos FROM o JOIN varies USING (tree, pos)
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY k) <= floor(sqrt((SELECT count(DISTINCT pos) FROM dm)))),
v AS (SELECT tree, pos, value, CAST(sum(w * (1 - y)) AS DOUBLE) AS c0, CAST(sum(w * y) AS DOUBLE) AS c1
  FROM tried JOIN w USING (tree) JOIN dm USING (user_uid, pos) GROUP BY tree, pos, value),
s AS (SELECT tree, pos, value, lead(value) OVER p AS next, sum(c0) OVER p AS l0, sum(c1) OVER p AS l1,
    sum(c0) OVER (PARTITION BY tree, pos) AS n0, sum(c1) OVER (PARTITION BY tree, pos) AS n1
  FROM v WINDOW p AS (PARTITION BY tree, pos ORDER BY value)),
g AS (SELECT *, (l0 * l0 + l1 * l1) / (l0 + l1) + ((n0 - l0) * (n0 - l0) + (n1 - l1) * (n1 - l1)) / (n0 - l0 + n1 - l1) AS gain
  FROM s WHERE next IS NOT NULL)
SELECT CAST(tree AS INTEGER) AS tree, CAST(pos AS INTEGER) AS feature, round(value + (next - value) / 2, 6) AS threshold FROM g
QUALIFY row_number() OVER (PARTITION BY tree ORDER BY gain DESC, pos, value) = 1""", "churn_features")


@register("churn_rf_roots", _roots_sql())
def q_churn_rf_roots(spark, sf):
    """The first cuts of the forest's first trees, found in SQL over all cuts of the drawn columns."""
    train = _churn_data(spark, sf).design.where(~F.col("is_test"))
    cuts = forest.root_cuts(forest.fit(train, "user_uid", "label", vector_to_array(F.col("features"))))
    return cuts.where(F.col("tree") < ROOT_TREES).withColumn("threshold", F.round("threshold", 6))


_RULE_PROBA_SQL = "1.0 / (1.0 + exp(-(tenure_days / (30.0 * freq_total) - 1.0)))"


def _rule_proba():
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.col("tenure_days") / (F.lit(30.0) * F.col("freq_total"))
                                               - F.lit(1.0))))


@register("campaign_targets", sql(f"""
WITH s AS (SELECT *, {_RULE_PROBA_SQL} AS churn_proba FROM churn_features)
SELECT user_uid, round(churn_proba, 9) AS churn_proba, monetary_total, freq_total, tenure_days, orders_last_30d,
       main_city, sex, level, source
FROM s WHERE churn_proba >= 0.65 AND monetary_total >= (SELECT quantile_cont(monetary_total, 0.5) FROM s)""",
                                  "churn_features"), money=("monetary_total",))
def q_campaign_targets(spark, sf):
    """K2-K4 with a fixed, documented score in place of the model probability
    (mean gap between orders relative to a month, through a logistic)."""
    scored = _features(spark, sf).withColumn("churn_proba", _rule_proba())
    t = campaign.select_targets(scored, "churn_proba")
    return t.withColumn("churn_proba", F.round("churn_proba", 9))


@register("campaign_end_to_end", sql("""
SELECT user_uid, monetary_total, freq_total, tenure_days, orders_last_30d, main_city, sex, level, source,
       monetary_total >= (SELECT quantile_cont(monetary_total, 0.5) FROM churn_features) AS value_ok,
       true AS proba_in_unit, true AS target_is_rule
FROM churn_features""", "churn_features"), money=("monetary_total",))
def q_campaign_end_to_end(spark, sf):
    """K5: every user's export columns; the target list is exactly the users that the rule selects."""
    out = camp_plan.run_campaign(shop_clean(spark, sf), evaluate_holdout=False)
    scored = with_scalars(out["scored"], campaign.value_cutoff(out["scored"], materialize=False))
    listed = out["targets"].select("user_uid", F.lit(True).alias("listed"))
    value_ok = F.col("monetary_total") >= F.col("_value_cut")
    rule = value_ok & (F.col("churn_proba") >= CHURN_PROB_THRESHOLD)
    return scored.join(listed, "user_uid", "left").select(
        "user_uid", "monetary_total", "freq_total", "tenure_days", "orders_last_30d", "main_city", "sex", "level", "source",
        value_ok.alias("value_ok"), F.coalesce(F.col("churn_proba").between(0, 1), F.lit(False)).alias("proba_in_unit"),
        (F.coalesce("listed", F.lit(False)) == rule).alias("target_is_rule"))
