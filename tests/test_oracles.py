"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver repeats this at sf0.01; ``python -m tests.oracle_harness`` too)."""

import pytest

import __spark_entry__ as ent
from tests.conftest import SF001
from tests.oracle_harness import canon, duck

from cartwheel.plans.registry import all_oracles  # the training-data queries have tests of their own

ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = ent.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    assert canon(df.columns, rows) == canon(rel.columns, rel.fetchall())


def test_every_query_of_the_registry_has_an_oracle():
    from cartwheel.plans.registry import all_oracles, all_queries
    assert set(all_queries()) == set(all_oracles())
