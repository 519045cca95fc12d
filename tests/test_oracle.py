"""Every registered query against its DuckDB oracle (the driver's gate)."""

import os

import pytest

import __spark_entry__ as E
from tessera.plans import registry
from tests.conftest import SF_CHECK, SF_SMALL
from tests.oracle_compare import duck, same

SF = os.environ.get("TESSERA_TEST_SF", SF_SMALL)
KEYS = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    no_sql = set(KEYS) - set(E.oracle_sql())
    assert not no_sql


@pytest.mark.parametrize("key", [k for k in KEYS if k in E.oracle_sql()])
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    ok, msg = same(df, con, E.oracle_sql()[key])
    assert ok, f"{key}: {msg}"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["term", "count"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF_CHECK), reason="sf0.01 not present")
@pytest.mark.parametrize("key", ["better_selling_similars", "top_reviewers", "catalog_roundtrip_reviews",
                                 "bucket_first_and_third_last"])
def test_selected_queries_at_sf001(spark, key):
    ok, msg = same(E.queries()[key](spark, SF_CHECK), duck(SF_CHECK), E.oracle_sql()[key])
    assert ok, f"{key}: {msg}"
