"""Plans push filters and columns down to the scans, and keep joins away from forced broadcasts."""

from __future__ import annotations

import pytest

from flowgauge.plans import load_all
from flowgauge.schemas import DOMAIN
from flowgauge.sources.domain import FRAMES
from tests.conftest import DATA

QUERIES = load_all()


def test_filters_reach_the_scan(spark):
    plan = QUERIES["scorecard_daily_snapshot"].run(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and ("orders" in line or "lineitem" in line)]
    assert scans and all("ReadSchema" in s for s in scans)
    assert any("o_orderdate" in s and "1998-0" in s for s in scans)


def test_scan_reads_only_the_needed_columns(spark):
    plan = QUERIES["time_to_restore_monthly"].run(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "o_orderstatus" not in scan


def test_only_written_out_relations_carry_a_broadcast_hint(spark):
    hinted = set()
    for name, q in QUERIES.items():
        if not name.startswith("table_") and "S2" not in q.covers and q.covers[0][0] in "FDCQ":
            text = q.run(spark, DATA)._jdf.queryExecution().analyzed().toString()
            if "strategy=broadcast" in text:
                hinted.add(name)
    assert hinted == set()


def nodes(spark, name, kind):
    plan = QUERIES[name].run(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    return sum(line.lstrip(" :+-").startswith(kind) for line in plan.splitlines())


def test_event_counts_expand_nothing_and_join_no_context(spark):
    assert nodes(spark, "top_issues_by_flow", "Expand") == 0
    assert nodes(spark, "top_issues_by_flow", "Join LeftOuter") == 1  # the sprint, after the cut to the top issues
    assert nodes(spark, "entity_counts_of_issue", "Join LeftOuter") == 0
    assert nodes(spark, "failed_steps_with_logs", "Join LeftOuter") == 1


def test_stage_badges_take_the_whole_fact(spark):
    q = QUERIES["stage_badges_by_issue"]
    for part in ("FROM flow_commits", "FROM flow_prs", "FROM flow_steps", "LEFT JOIN issues"):
        assert part in q.sql
    asked = q.run(spark, DATA)._jdf.queryExecution().analyzed().toString()
    assert asked.count("Union") == 2 and "Join LeftOuter" in asked and "jira_sprint" in asked


def test_stage_badges_read_all_kinds_of_events(spark, tables):
    out = QUERIES["stage_badges_by_issue"].run(spark, DATA)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" in plan and plan.count("orders.parquet") >= 2  # commits, pull requests and steps
    keys = [t.select("ticket_key") for t in (tables.flow_commits, tables.flow_prs, tables.flow_steps)]
    assert out.count() == keys[0].union(keys[1]).union(keys[2]).distinct().count() > keys[2].distinct().count()


@pytest.mark.parametrize("name", sorted(FRAMES))
def test_domain_frames_have_their_declared_schema(spark, tables, name):
    want = spark.createDataFrame([], DOMAIN[name]).schema
    got = getattr(tables, name).schema
    assert [(f.name, f.dataType.simpleString()) for f in got] == [(f.name, f.dataType.simpleString()) for f in want]
