"""A slice of the driver's correctness gate inside pytest (sf0.001): Spark
result vs the DuckDB oracle, compared as multisets of normalised rows."""

import importlib

import pytest

from tests.oracle_check import compare, duck

E = importlib.import_module("__spark_entry__")
SF = "/root/testdata/sf0.001"
NAMES = ["monthly_revenue", "fct_sales", "customer_segments", "top_products_by_city_wide",
         "promo_vs_no_promo", "revenue_by_store_series", "watermark_advance", "dq_suite_multi"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    assert compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF, con)


def test_approximate_segments_close_to_exact(spark):
    from tillhouse.plans import questions as Q
    from tillhouse.plans.warehouse import Warehouse
    m = Warehouse.from_driver_tables(spark, SF).marts_mt
    exact = {(r.city, r.segment): r.n_customers for r in Q.customer_segments(m["fct_sales"], m["dim_customer_mt"]).collect()}
    approx = {(r.city, r.segment): r.n_customers
              for r in Q.customer_segments(m["fct_sales"], m["dim_customer_mt"], exact=False).collect()}
    assert sum(exact.values()) == sum(approx.values())
