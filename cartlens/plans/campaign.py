"""End-to-end churn model and campaign list (K5 and the churn notebook).

order_kpi -> cut-off, labels, pre-T0 features -> user profile enrichment ->
design matrix -> hold-out evaluation -> refit on all rows -> scoring ->
target selection -> CSV.

``order_kpi`` feeds labels and features, and the design matrix feeds several
fits, so both are checkpointed once into the shared checkpoint folder (a
reliable copy: lost executors do not force a recompute from the raw scan).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlens.operators import campaign, churn, features, forest, kpi, models
from cartlens.schema import (CHURN_CATEGORICAL, CHURN_NUMERIC, CHURN_PERIOD_DAYS,
                             CHURN_PROB_THRESHOLD, CHURN_TEST_FRACTION, SEED, VALUE_PERCENTILE)
from cartlens.session import cut_lineage


@dataclass
class ChurnData:
    features: DataFrame   # raw feature table (one row per labelled user)
    design: DataFrame     # features + ``features`` vector + ``label`` + ``is_test``
    num_cols: list[str]
    cat_cols: list[str]


def churn_data(tables: dict[str, DataFrame], churn_period_days: int = CHURN_PERIOD_DAYS,
               test_fraction: float = CHURN_TEST_FRACTION, seed: int = SEED,
               user_columns: list[str] | None = None, checkpoint: bool = True,
               fit_stats_on_train: bool = False) -> ChurnData:
    """Labelled feature table and design matrix. ``fit_stats_on_train`` fits
    imputation and scaling on the training part only (no hold-out leakage);
    the default follows the reference (statistics over all rows)."""
    ok = kpi.order_kpi(tables["orders"], tables["order_details"])
    if checkpoint:
        ok = cut_lineage(ok)
    cut = churn.cutoff(ok, churn_period_days)
    users = tables["users"]
    if user_columns:
        users = users.select(*user_columns)
    feats = kpi.churn_features(churn.behavior_features(ok, cut), churn.churn_labels(ok, cut),
                               users, kpi.user_profile(tables["profiles"]))
    num = features.present(feats, CHURN_NUMERIC)
    cat = features.present(feats, CHURN_CATEGORICAL)
    base = features.exact_split_flag(feats.select("user_uid", "churned", *num, *cat), "user_uid",
                                     "churned", test_fraction, seed)
    prepared = features.prepare_design(base, num, cat, ~F.col("is_test") if fit_stats_on_train else None)
    design, _ = models.design_matrix(prepared, num, cat)
    design = design.withColumn("label", F.col("churned").cast("double"))
    if checkpoint:
        design = cut_lineage(design)
    return ChurnData(feats, design, num, cat)


def _scored(proba: DataFrame, df: DataFrame) -> DataFrame:
    """``proba`` (user_uid, churn_proba) with the label and the decision at one half."""
    return (df.select("user_uid", "churned").join(proba, "user_uid")
            .withColumn("prediction", (F.col("churn_proba") >= 0.5).cast("int")))


def _features() -> Column:
    return vector_to_array(F.col("features"))


def fit_and_score(train: DataFrame, rows: DataFrame, which: str = "rf") -> DataFrame:
    """(user_uid, churn_proba) of ``rows`` by a model fitted on ``train``: ``rf`` or ``lr``."""
    if which == "rf":
        model = forest.fit(train, "user_uid", "label", _features())
        return forest.predict(model, rows, "user_uid", _features()).withColumnRenamed("probability", "churn_proba")
    model = models.fit_reliably(models.logistic(train.count()), train, checkpoint=False)
    return model.transform(rows).select("user_uid", models.positive_probability().alias("churn_proba"))


def evaluate(data: ChurnData, which: str = "rf") -> tuple[DataFrame, DataFrame]:
    """Fit on the train part, score the test part: (test scores, metrics)."""
    test = data.design.where(F.col("is_test"))
    # The scores feed the metric and the caller.
    scored = cut_lineage(_scored(fit_and_score(data.design.where(~F.col("is_test")), test, which), test))
    auc = features.roc_auc(scored, "churned", "churn_proba").select(F.lit(which).alias("model"), "auc")
    return scored, auc


def lr_gradient(data: ChurnData) -> DataFrame:
    """Gradient per design column of the logistic model fitted on the train part (zero at the optimum)."""
    train = data.design.where(~F.col("is_test"))
    n = train.count()
    model = models.fit_reliably(models.logistic(n), train, checkpoint=False)
    return models.logistic_gradient(model, train, 1.0 / n)


def run_campaign(tables: dict[str, DataFrame], prob_threshold: float = CHURN_PROB_THRESHOLD,
                 value_percentile: float = VALUE_PERCENTILE, out_csv: str | None = None,
                 evaluate_holdout: bool = True) -> dict[str, DataFrame]:
    """K5: returns ``targets`` and ``scored`` (and ``holdout_auc``, ``report`` when evaluated)."""
    data = churn_data(tables, user_columns=["user_uid", "source", "language"])
    out: dict[str, DataFrame] = {}
    if evaluate_holdout:
        scored, auc = evaluate(data, "rf")
        out["holdout_auc"] = auc
        out["report"] = features.classification_report(scored, "churned", "prediction")
    scored_all = data.features.join(fit_and_score(data.design, data.design), "user_uid")
    out["scored"] = scored_all = cut_lineage(scored_all)
    out["targets"] = campaign.select_targets(scored_all, "churn_proba", prob_threshold, value_percentile)
    if out_csv:
        campaign.export_csv(out["targets"], out_csv)
    return out
