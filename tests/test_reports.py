"""The notebook-level plans return the same tables as the registered keys."""

import tempfile

import __spark_entry__ as entry
from cartlens.plans.etl import shop_clean
from cartlens.plans.reports import analysis_report, rfm_report, write_report
from cartlens.queries.common import AS_OF
from cartlens.sources import shop_tables as st

from conftest import SMALL

Q = entry.queries()


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(*a.columns)).count() == 0


def test_analysis_report_matches_keys(spark):
    t = shop_clean(spark, SMALL)
    rep = analysis_report(t, AS_OF, st.products(spark, SMALL))
    for key in ("revenue_by_city_top10", "one_time_vs_repeat", "age_histogram", "order_volume_monthly",
                "revenue_by_product_type", "top_languages"):
        assert same(rep[key], Q[key](spark, SMALL)), key


def test_rfm_report_and_write(spark):
    rep = rfm_report(shop_clean(spark, SMALL))
    assert same(rep["segment_counts"], Q["rfm_segment_counts"](spark, SMALL))
    out = tempfile.mkdtemp(prefix="cartlens-report-")
    write_report(rep, out)
    assert spark.read.parquet(f"{out}/rfm").count() == rep["rfm"].count()
