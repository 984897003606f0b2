"""Plan shapes that keep the queries fit for large tables."""

import re

import pytest

from frames import rows
from tillworks.operators import customer_marts as CM
from tillworks.operators import ledger as L
from tillworks.operators import sales_marts as SM
from tillworks.operators import reports as R
from tillworks.plans import registry, workspace
from tillworks.sources.testdata import bronze_lines

SF_DIR = "/root/testdata/sf0.001"
STREAMED = {"stream_bronze", "refresh_touched_months", "stream_daily_sales"}
ZIPPED = {"read_workbooks"}  # rows come out of zipped XML
QUERIES = registry.queries()


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def silver(spark):
    return workspace.silver(spark, SF_DIR)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED - ZIPPED))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "MapInArrow"]:
        assert operator not in text


def test_months_prune_folders(silver):
    months = L.recompute_months(silver["fact_sales_daily"], silver["dim_date"], [(1998, 5)])
    assert re.search(r"PartitionFilters: \[[^]]*\* 100", plan(months))


def test_top_one_is_limited_before_the_shuffle(silver):
    for df in [SM.top_product_per_country(silver["fact_sales_daily"]), CM.primary_country(silver["fact_sales_daily"])]:
        assert plan(df).count("WindowGroupLimit") >= 2


def test_marts_do_not_expand_rows(spark, silver):
    fact, dates, products = silver["fact_sales_daily"], silver["dim_date"], silver["dim_product"]
    for df in [
        CM.customer_lifetime_value(fact, dates, products),
        CM.customer_monthly_activity(fact, dates),
        CM.customer_product_affinity(fact, products, dates),
        SM.sales_monthly(fact, dates),
        SM.sales_monthly(fact, dates, count_unknown=True),
        SM.product_performance(fact, products, dates),
        SM.country_sales(fact, dates),
        SM.sales_daily_enhanced(fact, dates),
        SM.monthly_sales_summary(fact, dates),
        SM.top_products_by_revenue(fact, products),
        SM.country_performance(fact, dates),
        R.bronze_summary(workspace.bronze(spark, SF_DIR)),
    ]:
        assert "Expand" not in plan(df)


def test_scans_read_only_needed_columns(spark):
    from tillworks.operators import silver as S

    text = plan(S.fact_sales_daily(bronze_lines(spark, SF_DIR), *workspace.dimensions(spark, SF_DIR)))
    for unused in ["l_extendedprice", "l_shipdate", "o_totalprice", "c_acctbal", "p_retailprice"]:
        assert f"{unused}:" not in text.split("== Physical Plan ==")[1]
