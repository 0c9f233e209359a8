"""Registered queries: one Spark callable and, where SQL can say it, one
DuckDB oracle per key. ``__spark_entry__`` exposes both dictionaries.

Every query reads the supplied tables (through :mod:`cartlens.sources`) over
their full extent; nothing is sampled or capped except the top-k reports,
where the limit is the feature.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Digits to which a registered query's money columns are rounded (double sums depend on the order of the rows).
MONEY_DIGITS = {"amount_paid_eur": 2, "order_revenue": 2, "revenue": 2, "monetary": 2, "monetary_total": 2,
                "avg_order_value": 8}


def register(name: str, oracle: str | None = None, money: tuple[str, ...] = ()):
    """Register a query; the ``money`` columns of its result and of its oracle's are rounded."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")

        @functools.wraps(fn)
        def rounded(spark, sf):
            return fn(spark, sf).withColumns({c: F.round(c, MONEY_DIGITS[c]) for c in money})
        QUERIES[name] = rounded if money else fn
        if oracle is not None:
            replaced = ", ".join(f"round({c}, {MONEY_DIGITS[c]}) AS {c}" for c in money)
            ORACLES[name] = f"SELECT * REPLACE ({replaced}) FROM (\n{oracle}\n)" if money else oracle
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from cartlens.queries import (q_analytics, q_ingest, q_models, q_quality,  # noqa: F401
                                  q_text)


_load_all()
