"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from cartlens.oracles.compare import compare, duck

from conftest import SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()
# Training-data operators and the results of fitted models, held against brute force, Newton's method and
# SQL over the returned scores in test_forest and test_softmax, go without a SQL twin.
FITTED = ["campaign_scores", "churn_lr_scores", "churn_rf_scores", "model_auc", "sentiment_coefficients", "sentiment_predictions"]
WITHOUT_SQL = [k for k in QUERIES if k not in ORACLES and k != "pipeline" and not k.startswith("op")]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", sorted(k for k in ORACLES if k != "pipeline" and not k.startswith("op")))
def test_oracle_parity(spark, con, key):
    o = compare(spark, con, key, QUERIES[key], ORACLES[key], SMALL)
    assert o.status == "OK", o.detail


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["segment", "num_users"] and len(rows) > 0


def test_every_key_has_an_oracle():
    assert sorted(WITHOUT_SQL) == FITTED
