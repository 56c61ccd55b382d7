"""The driver contract: entry smoke, registry shape and the oracle gate."""

import pytest

import __spark_entry__ as entry_mod
from tools.oracle_check import compare, duck

from inputs import SF_SMALL


def test_entry_runs_on_smoke_data(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["destination_city", "num_entregas"]
    assert df.count() >= 0


def test_every_oracle_has_a_query():
    qs, oracle = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(oracle) <= set(qs)
    from parcelflow.plans import catalog

    own = set(catalog.spark_queries())
    assert len(own) >= 65
    assert own <= set(oracle)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_queries()))
def test_query_matches_oracle(spark, con, name):
    ok, n_spark, n_oracle, detail = compare(
        spark, con, name, entry_mod.queries()[name], entry_mod.oracle_sql()[name], SF_SMALL
    )
    assert ok, f"{name}: {n_spark} vs {n_oracle} rows; {detail}"
