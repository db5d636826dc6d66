"""Every registered query against its reference SQL, on the smallest scale folder."""

import compare
import pytest

from rfsight.plans.catalogue import CATALOGUE, run

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query_equals_reference_sql(spark, con, name):
    query = CATALOGUE[name]
    assert query.sql, f"{name} has no reference SQL"
    found = compare.differences(run(name, spark, SF_DIR), con, query.sql)
    assert not found, "\n".join(found)


def test_entry_returns_alerts(spark):
    import __spark_entry__ as contract_

    df = contract_.entry(spark)
    assert "threat_score" in df.columns and df.count() > 0
    assert set(contract_.oracle_sql()) <= set(contract_.queries())
