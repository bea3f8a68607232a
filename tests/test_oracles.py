"""Every registered query against its SQL, on the smallest data."""

from __future__ import annotations

import os

import pytest

from flowgauge.plans import load_all
from tests.conftest import DATA
from tests.oracle_check import compare, connect
from tools.plan_audit import findings

QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    q = QUERIES[name]
    assert q.sql is not None
    df = q.run(spark, DATA)
    # The plan keeps a shape that scales: no nested loop, no cartesian product, no unpartitioned window, no Python.
    assert not {"nested loop", "cartesian", "python", "global window"} & set(findings(df._jdf.queryExecution().executedPlan().toString()))
    problem, _ = compare(df, con, q.sql)
    assert not problem, problem


def test_every_inventory_row_has_a_query():
    numbers = {
        "S": [1, 2, *range(4, 11), 12, 13, 14, 15], "F": range(1, 24), "D": [*range(1, 12), *range(13, 17)], "C": range(1, 27), "A": range(1, 32),
        "Q": range(1, 23), "V": range(1, 12), "R": range(1, 10), "P": range(1, 5), "X": [1, *range(3, 18)],
        "K": [1, 2, 3, 7, 8, 9, 13, 14],
    }
    wanted = {f"{k}{n}" for k, ns in numbers.items() for n in ns}
    assert wanted - {c for q in QUERIES.values() for c in q.covers} == set()


def test_entry_and_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(QUERIES) <= set(e.queries())
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
