"""Every registered query against its SQL on the smallest tables, and a look at its plan."""

import re

import pytest

import __spark_entry__ as entry_points
from rowsmith.plans import registry
from tests.oracle_check import compare, connect

# Their plans are a scan of what a stream or a file round trip has written by then.
RAN_ALREADY = {"read_rates", "upsert_snapshot", "write_lines"}
# On the smallest tables these find nothing to report.
EMPTY_OK = {"stream_tumbling_counts", "stream_sliding_counts"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, con, name):
    df = entry_points.queries()[name](spark, sf)
    if not name.startswith("stream_") and name not in RAN_ALREADY:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        # A window that starts with its order has no partition column. One may: the carry
        # rows (one per shuffle partition).
        unpartitioned = re.findall(r"windowspecdefinition\((\w+)#\d+L? (?:ASC|DESC)", plan)
        assert set(unpartitioned) <= {"_scan_part"}
    good, note = compare(spark, con, sf, name, lambda *_: df, entry_points.oracle_sql().get(name))
    assert good or (name in EMPTY_OK and "(empty)" in note), note


def test_every_check_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["source", "lines_kept", "copies_dropped"] and df.count() > 0
