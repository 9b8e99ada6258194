"""Every query of the folder over the smallest tables: against its SQL where there is one."""

import pytest

import __spark_entry__ as entry_points
from rowsmith.llm import queries
from tests.oracle_check import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, con, name):
    df = queries.QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    good, note = compare(spark, con, sf, name, lambda *_: df, queries.ORACLES.get(name))
    assert good, note


def test_all_are_registered():
    known = entry_points.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(known) and set(queries.ORACLES) <= set(entry_points.oracle_sql())
