"""The query catalog against DuckDB. Set CATALOG=all to run every query."""

import os

import pytest

import __spark_entry__ as driver
from verification.check import compare, connect
from verification.oracles import oracle_sql
from verification.queries import queries

SF = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
SOME = ["quality_cube", "alerts", "masked_rules", "uniqueness_without_nulls", "availability_by_month", "load_arrival",
        "balance_alerts", "score_deltas", "pareto_peers", "premium_by_source", "aligned_series", "premium_mom_calendar",
        "reconciled_amounts", "refreshed_cube"]
NAMES = sorted(queries()) if os.environ.get("CATALOG") == "all" else SOME


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables are not available")
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql()) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, SF) == ""


def test_entry(spark, duck):
    assert driver.entry(spark).columns[:4] == ["periodo_contable", "periodo_fecha", "tipo_indicador", "nombre_campo"]
