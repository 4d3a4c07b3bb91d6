"""Every query of the library against its SQL, and what its plan may not hold."""

import pytest

import __spark_entry__ as entry
from tablewright.plans.catalog import ORACLES, QUERIES
from tests.compare import compare, connect
from tests.helpers import plan

PYTHON = {
    "month_by_registered_function", "words_by_table_function", "stream_running_totals",
}
NO_PYTHON = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow")


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, small, duck, name):
    """The rows of the SQL, by a plan without row-at-a-time Python and without cross joins."""
    made = []

    def make(*args):
        made.append(QUERIES[name](*args))
        return made[0]

    assert compare(spark, duck, small, name, make, ORACLES.get(name)) == ""
    text = plan(made[0])
    for part in ("CartesianProduct", "BroadcastNestedLoopJoin", *([] if name in PYTHON else NO_PYTHON)):
        assert part not in text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


def test_scan_reads_only_what_is_used(spark, small):
    text = plan(QUERIES["segment_counts"](spark, small))
    assert "ReadSchema: struct<c_acctbal:double,c_mktsegment:string>" in text
    assert "GreaterThan(c_acctbal,0.0)" in text


def test_top_rows_are_cut_before_the_shuffle(spark, small):
    text = plan(QUERIES["latest_order_row_number"](spark, small))
    assert "WindowGroupLimit" in text and "Partial" in text
