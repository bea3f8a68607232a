"""Ranks, steps, sets and buckets that hold when one key owns most rows, against plain Python."""

from __future__ import annotations

import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import assist as aa
from flowgauge.operators import delivery as dl
from flowgauge.operators import profile as pf
from flowgauge.operators import release as rl
from flowgauge.operators.ordering import exact_median, refined_bucket


@pytest.mark.parametrize("ranges", [2, 1 << 15])
def test_median_by_rank_selection(spark, ranges):
    rng = random.Random(2)
    rows = [("hot", rng.choice([0, 5, 10**9, rng.randint(0, 2000)])) for _ in range(3000)] + [("two", 1), ("two", 4), ("one", -7), ("none", None)]
    counted = spark.createDataFrame(rows, "k string, v long").groupBy("k", "v").agg(F.count("*").alias("n"))
    got = {r.k: r.m for r in exact_median(counted, ["k"], "v", "n", "m", ranges=ranges).collect()}
    want = {k: float(statistics.median([v for x, v in rows if x == k])) for k in ("hot", "two", "one")}
    assert got == want


def test_a_distant_fact_costs_one_row(spark):
    steps = spark.createDataFrame([("a", date(2024, 1, 5), 3), ("a", date(2024, 2, 9), 7), ("b", date(2024, 3, 1), 1)], "k string, from_day date, v long")
    days = [date(2023, 1, 1), date(2024, 1, 5), date(2024, 1, 31), date(2024, 2, 8), date(2024, 2, 9), date(9999, 12, 31), None]
    facts = spark.createDataFrame([(k, d, 1) for k in ("a", "b", "c") for d in days], "k string, d date, x int")
    out = aa.as_of(facts, steps, ["k"], "d", "v")
    assert out.columns == ["k", "d", "x", "v"]
    got = {(r.k, r.d): r.v for r in out.collect()}
    assert [got["a", d] for d in days] == [None, 3, 3, 3, 7, 7, None]
    assert [got["b", d] for d in days] == [None] * 5 + [1, None] and {got["c", d] for d in days} == {None}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no row per day


def test_seats_without_a_row_per_seat_and_day(spark):
    day = date(2024, 1, 1)
    seats = [("o", "u1", day - timedelta(9)), ("o", "u1", day + timedelta(2)), ("o", "u2", day + timedelta(1)), ("p", "u3", day + timedelta(50))]
    usage = [("u1", day), ("u1", day), ("u1", day + timedelta(2)), ("u2", day), ("u2", day + timedelta(3)), ("x", day)]
    got = aa.seat_activity(
        spark.createDataFrame(seats, "org_name string, assignee_login string, created_at date"),
        spark.createDataFrame(usage, "user_login string, usage_date date"), "2024-01-01", "2024-01-04",
    )
    want = [(0, 1, 1, 0, 2), (1, 2, 0, 2, None), (2, 3, 2, 1, 2), (3, 3, 1, 2, 1)]
    assert sorted(tuple(r) for r in got.collect()) == [("o", day + timedelta(i), s, a, n, x) for i, s, a, n, x in want]
    assert "sequence" not in got._jdf.queryExecution().optimizedPlan().toString().split("Join")[-1]


def test_a_day_with_most_deploys_is_cut(spark):
    rng = random.Random(4)
    rows = [(i, "hot", datetime(2024, 1, 1, 12), f"s{i}", "success") for i in rng.sample(range(10_000), 900)]
    rows += [(20_000 + i, "hot", datetime(2024, 1, 1 + i % 3, i % 24), f"t{i}", "success") for i in range(60)]
    rows += [(30_000 + i, f"p{i % 3}", datetime(2024, 1, 2), f"u{i}", "success") for i in range(9)]
    df = spark.createDataFrame(rows, "run_id long, project_name string, pipeline_started_at timestamp_ntz, pipeline_commit_sha string, pipeline_status string")
    got = {r.run_id: r.from_sha for r in dl.deploy_chain(df, most=50).collect()}
    want, last = {}, {}
    for run, project, _, sha, _ in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        want[run], last[project] = last.get(project), sha
    assert got == want
    cut = refined_bucket(df, ["project_name"], F.to_date("pipeline_started_at"), ["run_id"], "b", most=50, levels=2)
    assert max(r["count"] for r in cut.groupBy("project_name", "b").count().collect()) <= 100


def test_cube_counts_distinct_users_without_expanding_them(spark):
    rng = random.Random(5)
    names = list(aa.SUMS)
    rows = [(date(2024, 1, rng.randint(1, 20)), rng.choice(["u1", "u2", "u3", None, "u9"]), rng.choice("ab"), rng.choice(["x", None]), *[rng.randint(0, 5)] * 6) for _ in range(200)]
    df = spark.createDataFrame(rows, "usage_date date, user_login string, tool string, model string, " + ", ".join(f"{n} long" for n in names))
    out = aa.weekly_matrix(df, ["tool", "model"])
    got = {(r.week, r.grouping_bits, r.tool, r.model): (r.generated, r.engaged_users) for r in out.collect()}
    week = lambda d: d - timedelta(d.weekday())
    for bits in range(4):
        for w, t, m in {(week(r[0]), None if bits & 2 else r[2], None if bits & 1 else r[3]) for r in rows}:
            mine = [r for r in rows if week(r[0]) == w and (bits & 2 or r[2] == t) and (bits & 1 or r[3] == m)]
            assert got.pop((w, bits, t, m)) == (sum(r[5] for r in mine), len({r[1] for r in mine} - {None}))
    assert not got
    expand = out._jdf.queryExecution().optimizedPlan().toString().split("Expand")
    assert len(expand) == 2 and "user_login" not in expand[0].splitlines()[-1]


def test_release_arrays_are_read_once(spark):
    df = spark.createDataFrame(
        [("v1", ['{"tool_type":"t","build_status":"success"}', "broken"], None), ("v2", None, ['{"tool_type":"g","step_status":"failed"}']), ("v3", None, None)],
        "fix_version string, builds array<string>, gates array<string>",
    )
    got = sorted(map(tuple, rl.pass_rates(df).collect()), key=repr)
    assert got == sorted([("v1", "build", "t", 1, 100.0), ("v1", "build", None, 1, 0.0), ("v2", "gate", "g", 1, 0.0)], key=repr)
    assert rl.pass_rates(df)._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1


def test_funnel_reads_its_source_once(spark):
    df = spark.range(10)
    got = pf.stage_funnel(df, [("all", F.count("*")), ("even", F.count_if(F.col("id") % 2 == 0)), ("distinct", F.count_distinct(F.col("id") % 3))])
    assert [tuple(r) for r in got.collect()] == [(0, "all", 10), (1, "even", 5), (2, "distinct", 3)]
