"""Every registered query against its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as E
from adsieve.plans.catalog import REGISTRY
from paths import SF001
from oracle_harness import run

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def results(spark):
    return run(spark, SF001, NAMES, verbose=False)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(results, name):
    ok, msg = results[name]
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["campaign_id", "total_impressions", "total_clicks", "total_conversions", "hour_bucket"]
