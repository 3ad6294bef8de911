"""The operators' queries against their DuckDB twins (sf0.001)."""

import pytest
from oracle_harness import run

from adsieve.llm.queries import ORACLE_SQL, QUERIES

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(lspark):
    return run(lspark, SF001, sorted(QUERIES), verbose=False)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_twin(results, name):
    ok, msg = results[name]
    assert ok, msg
    assert name in ORACLE_SQL or msg.startswith("rows-only")


def test_every_query_is_registered():
    import __spark_entry__ as E
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
