"""One population for all delivery metrics: repositories, stages, statuses and projects of a level's configuration."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import delivery as dl

FLAT = "kpi string, level_3 string, project_url array<string>, project_name array<string>, deployment_stages array<string>, pipeline_status_success array<string>"
DAY = datetime(2024, 3, 5)


@pytest.fixture()
def flat(spark):
    rows = []
    for kpi in ("df", "lt"):
        rows += [(kpi, "A", ["u/one.git"], None, ["deploy"], ["success"]), (kpi, "B", ["u/one", "u/two"], None, ["build", "ship"], ["success", "partial"])]
        rows += [(kpi, "C", ["u/two"], None, None, ["success"]), (kpi, "D", None, None, ["deploy"], ["success"])]
    rows += [("cfr", "A", None, ["P"], None, None), ("mttr", "B", None, ["P", "Q"], None, None), ("cfr", "D", None, [], None, None)]
    return spark.createDataFrame(rows, FLAT)


@pytest.fixture()
def deploys(spark):
    runs = [("u/one", "deploy", "success"), ("u/one.git", "deploy", "failed"), ("u/one", "build", "partial"), ("u/two", "ship", "success"), ("u/two", "deploy", "success"), ("u/x", "deploy", "success"), ("u/one", "deploy", "running")]
    rows = [(i, u, s, st, "t", DAY, f"sha{i}") for i, (u, s, st) in enumerate(runs)]
    return spark.createDataFrame(rows, "run_id long, project_url string, step_name string, pipeline_status string, team string, pipeline_started_at timestamp_ntz, pipeline_commit_sha string")


def test_a_stage_counts_only_where_it_is_configured(flat, deploys):
    got = dl.frequency_in_scope(deploys, dl.deploy_rules(flat), "df", "month").collect()
    assert sorted((r.level, r.success_deployments, r.failed_deployments) for r in got) == [("A", 1, 1), ("B", 2, 0)]


def test_lead_time_follows_the_same_rules(spark, flat, deploys):
    commits = spark.createDataFrame([("sha0", datetime(2024, 3, 1)), ("sha0", datetime(2024, 3, 6)), ("sha2", DAY), ("sha4", DAY), ("sha6", DAY)], "to_sha string, committed_date timestamp_ntz")
    got = dl.lead_time_in_scope(deploys, commits, dl.deploy_rules(flat), "lt", "month").collect()
    assert sorted((r.level, r.commits_count, r.commits_after_deploy, r.total_ltfc) for r in got) == [("A", 2, 1, 3), ("B", 1, 0, 0)]


def test_tickets_count_for_the_levels_that_list_their_project(spark, flat):
    rows = [("P", DAY, "c1", None, None), ("P", None, "c2", None, "c2"), ("Q", DAY, "c3", "c3", "c3"), ("R", DAY, "c4", "c4", "c4")]
    incidents = spark.createDataFrame(
        [(p, "t", DAY, done, c, f, m) for p, done, c, f, m in rows],
        "issue_project string, team string, issue_created timestamp_ntz, issue_resolution_date timestamp_ntz, cfr_total_changes_key string, cfr_total_failures_key string, mttr_issue_key string",
    )
    rules = dl.ticket_rules(flat, ["cfr", "mttr"])
    got = {r.level: r for r in dl.tickets_in_scope(incidents, rules, "cfr", "mttr", "month").collect()}
    assert got.keys() == {"A", "B"}
    assert (got["A"].cfr_total_changes, got["A"].cfr_total_failures, got["A"].total_incidents) == (1, 0, None)
    assert (got["B"].cfr_total_changes, got["B"].total_incidents, got["B"].resolved_incidents) == (None, 2, 1)
    alone = dl.tickets_in_scope(incidents, rules, "cfr", None, "month")
    assert [r.level for r in alone.collect()] == ["A"] and "total_incidents" not in alone.columns
    assert alone._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2  # tickets and rules once each


def test_levels_take_the_place_of_the_facts_own(spark):
    from flowgauge.operators.filters import array_filter_join

    filt = spark.createDataFrame([("A", ["P"], None, ["Done"], None), ("B", None, ["1"], ["Done"], None)], "level string, project_name array<string>, board_ids array<string>, issue_status array<string>, include_issue_types array<string>")
    fact = spark.createDataFrame([("x", "P", ["1", "2"], "Done", "Bug"), ("x", "Q", ["1"], "Done", "Bug"), ("x", "P", ["2"], "Open", "Bug")], "level string, issue_project string, board_ids array<string>, issue_status string, issue_type string")
    got = array_filter_join(fact, filt, carry=["level"])
    assert sorted(got.columns) == sorted(fact.columns)
    assert sorted((r.level, r.issue_project) for r in got.collect()) == [("A", "P"), ("B", "P"), ("B", "Q")]
    assert array_filter_join(fact, filt).filter(F.col("level") == "x").count() == 2
