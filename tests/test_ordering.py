"""Ordering helpers against brute force, with a hot key, NULL keys and ties."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import ordering as od


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    keys = ["hot"] * 600 + ["a", "b", None] * 60
    return [(k, rng.randrange(40), i, f"v{rng.randrange(500)}") for i, k in enumerate(keys)]


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "k string, day int, id int, v string").repartition(7)


def by_key(data):
    out = {}
    for r in data:
        out.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in out.items()}


def test_previous_value(frame, data, rows):
    got = rows(od.previous_value(frame, ["k"], ["day", "id"], "v", "prev", F.expr("day div 10")), "id", "prev")
    want = []
    for group in by_key(data).values():
        want += [(r[2], group[i - 1][3] if i else None) for i, r in enumerate(group)]
    assert got == sorted(want, key=repr)


def test_previous_value_keeps_null_values(spark, rows):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 2, 2, None), ("a", 11, 3, "z"), ("a", 12, 4, "w")], "k string, day int, id int, v string")
    got = rows(od.previous_value(df, ["k"], ["day", "id"], "v", "prev", F.expr("day div 10")), "id", "prev")
    assert got == [(1, None), (2, "x"), (3, None), (4, "z")]


def test_position_in_key(frame, data, rows):
    got = rows(od.position_in_key(frame, ["k"], ["day", "id"], "pos", F.expr("day div 7")), "id", "pos", "pos_count")
    want = []
    for group in by_key(data).values():
        want += [(r[2], i, len(group)) for i, r in enumerate(group)]
    assert got == sorted(want, key=repr)


def test_top_rows_and_latest_record(frame, data, rows):
    order = [F.desc("day"), F.desc("id")]
    got = rows(od.top_rows(frame, ["k"], order, 3), "k", "id", "rank_in_key")
    want = [(k, r[2], i + 1) for k, g in by_key(data).items() for i, r in enumerate(g[::-1][:3])]
    assert got == sorted(want, key=repr)
    assert rows(od.latest_record(frame, ["k"], order), "id") == sorted([(g[-1][2],) for g in by_key(data).values()], key=repr)


def test_top_rows_cuts_before_the_shuffle(frame):
    plan = od.top_rows(frame, ["k"], [F.desc("day"), F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_latest_per_key_keeps_ties_per_key(frame, data, rows):
    got = rows(od.latest_per_key(frame, ["k"], "day"), "k", "id")
    want = [(k, r[2]) for k, g in by_key(data).items() for r in g if r[1] == g[-1][1]]
    assert got == sorted(want, key=repr)


def test_newer_snapshot_of_one_key_does_not_hide_others(spark, rows):
    df = spark.createDataFrame([("old", 1, "x"), ("old", 2, "y"), ("new", 9, "z")], "org string, at int, who string")
    assert rows(od.latest_per_key(df, ["org"], "at"), "org", "who") == [("new", "z"), ("old", "y")]
