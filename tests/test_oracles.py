"""Every query of the catalog against its DuckDB oracle (the driver's gate) at
sf0.001; ``oracle_harness.py`` runs the same at sf0.01."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle_harness import compare, duck
from txprep.plans.catalog import ORACLES, QUERIES

@pytest.fixture(scope="module")
def con():
    return duck(SF["0.001"])


def test_registry_shape():
    assert set(QUERIES) == set(ORACLES)
    q, o = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(q) and set(ORACLES) <= set(o) <= set(q)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLES[name], SF["0.001"], con)
    assert r.get("ok") is True, r
    assert r["rows"] > 0


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 916
    assert df.columns[-2:] == ["tx_fraud", "tx_fraud_scenario"]
