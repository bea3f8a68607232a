"""Metric operators on hand-made frames: bands, empty periods, ties, negative durations, corrected defects."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from flowgauge.functions.bands import answer_score, band
from flowgauge.functions.columns import flag, seconds_between, week_label
from flowgauge.operators import activity as ac
from flowgauge.operators import delivery as dl
from flowgauge.operators import flow as fw
from flowgauge.operators import quality as ql
from flowgauge.operators import survey as sv
from flowgauge.operators import telemetry as tm

NTZ = "timestamp_ntz"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


@pytest.mark.parametrize(
    ("metric", "steps"),
    [
        ("df", [(30, "elite"), (29, "high"), (10, "high"), (3, "medium"), (2, "low"), (None, None)]),
        ("ltfc", [(1, "elite"), (1.01, "high"), (7, "high"), (30, "medium"), (31, "low")]),
        ("cfr", [(0, "elite"), (15, "elite"), (30, "high"), (45, "medium"), (45.1, "low")]),
        ("mttr", [(1, "elite"), (24, "high"), (168, "medium"), (169, "low"), (None, None)]),
    ],
)
def test_bands_at_their_edges(spark, metric, steps):
    df = spark.createDataFrame([(float(v) if v is not None else None, w) for v, w in steps], "v double, want string")
    assert df.filter(~band(metric, "v").eqNullSafe(F.col("want"))).count() == 0


def test_answer_scores(spark):
    pairs = [("Yes", 100), ("No", 0), ("1", 0), ("3", 50), ("5", 100), ("6", 0), ("0", 0), ("n/a", 0), (None, 0), ("yes", 0)]
    df = spark.createDataFrame(pairs, "a string, want int")
    assert df.filter(answer_score("a") != F.col("want")).count() == 0


def test_flag_spellings(spark):
    pairs = [("Y", True), ("true", True), ("TRUE", True), ("N", False), ("", False), (None, False)]
    df = spark.createDataFrame(pairs, "a string, want boolean")
    assert df.filter(flag("a") != F.col("want")).count() == 0


def test_week_labels_and_seconds(spark, rows):
    df = spark.createDataFrame([(date(2025, 4, 7),), (date(2025, 4, 28),), (date(2025, 9, 1),)], "d date")
    assert rows(df.select(week_label("d").alias("w"))) == [("Apr W1 2025",), ("Apr W4 2025",), ("Sep W1 2025",)]
    spans = spark.createDataFrame([(datetime(2024, 3, 30, 23, 59, 30), datetime(2024, 4, 1, 0, 0, 15))], f"a {NTZ}, b {NTZ}")
    assert rows(spans.select(seconds_between("a", "b").alias("s"))) == [(86445,)]


@pytest.fixture(scope="module")
def deploys(spark):
    return spark.createDataFrame(
        [
            ("L", "t1", "p", "deploy", "success", at(1), "s1", 1),
            ("L", "t1", "p", "deploy", "failed", at(1), None, 2),
            ("L", None, "p", "deploy", "success", at(3), "s3", 3),
            ("L", "t2", "p", "build", "success", at(3), "s4", 4),
            ("L", "t2", "q", "deploy", "running", at(4), None, 5),
        ],
        f"level string, team string, project_name string, step_name string, pipeline_status string, pipeline_started_at {NTZ}, "
        "pipeline_commit_sha string, run_id int",
    )


def test_frequency_counts_finished_deploy_steps_only(deploys, rows):
    got = rows(dl.deployment_frequency(deploys, "month", ["level"]), "success_deployments", "failed_deployments")
    assert got == [(2, 1)]


def test_lead_time_counts_commits_after_the_deploy_apart(spark, deploys, rows):
    commits = spark.createDataFrame([("s1", datetime(2023, 12, 30)), ("s1", at(2)), ("s3", at(3)), ("zz", at(1))], f"to_sha string, committed_date {NTZ}")
    assert rows(dl.lead_time(deploys, commits, "month", ["level"]), "commits_count", "commits_after_deploy", "total_ltfc") == [(3, 1, 1)]


def test_total_row_is_told_from_a_null_team(deploys, rows):
    sums = dl.combine([dl.deployment_frequency(deploys, "month")])
    got = rows(dl.with_sublevels(sums), "sub_level", "is_total", "success_deployments")
    assert got == sorted([(None, True, 2), (None, False, 1), ("t1", False, 1)], key=repr)


def test_daily_snapshot_fills_idle_days(deploys, rows):
    sums = dl.with_sublevels(dl.combine([dl.deployment_frequency(deploys, "day")]))
    got = rows(dl.daily_snapshot(sums, "2023-12-31", "2024-01-04"), "sub_level", "date", "success_deployments")
    # Total, t1 and the NULL team: each has all five days, though two of them carry the label NULL.
    assert len(got) == 15
    assert [r for r in got if r[0] == "t1"] == [("t1", date(2023, 12, 31), 0), *[("t1", date(2024, 1, d), int(d == 1)) for d in range(1, 5)]]


def test_failure_rate_is_zero_without_changes(spark, rows):
    sums = spark.createDataFrame([(0, 0), (4, 1)], "cfr_total_changes long, cfr_total_failures long")
    assert rows(dl.score(sums), "cfr_value", "cfr_flag") == [(0.0, "elite"), (25.0, "high")]


def test_deploy_chain_skips_failed_runs(deploys, rows):
    assert rows(dl.deploy_chain(deploys), "run_id", "from_sha") == [(1, None), (3, "s1"), (4, "s3")]


def test_survey_dimensions_have_both_periods_and_do_not_inflate(spark, rows):
    answers = [("s1", "r1", "q0", "5", at(20)), ("s2", "r1", "q0", "5", at(21)), ("s3", "r1", "q0", "3", at(22)), ("s0", "r1", "q0", "1", at(10))]
    df = spark.createDataFrame(answers, f"survey_id string, response_id string, question_id string, answer string, last_submitted_timestamp {NTZ}")
    got = rows(sv.space_dimensions(df, {"q0": "s"}, "2024-01-16", "2024-01-29"), "period", "s_score", "p_score")
    assert got == [("current_period", 83.33, None), ("previous_period", 0.0, None)]


def test_periods_without_rows_still_report(spark, rows):
    commits = spark.createDataFrame([("c", date(2024, 1, 20))], "commit_id string, commit_date date")
    prs = spark.createDataFrame([], f"pr_created_datetime {NTZ}")
    assert rows(sv.activity_by_period(commits, prs, "2024-01-16", "2024-01-29"), "period", "n_commits", "n_prs") == [
        ("current_period", 1, 0), ("previous_period", 0, 0),
    ]


def test_pr_class_and_stages(spark, rows):
    kind = "array<struct<sha:string,commit_timestamp:string,copilot_commit_flag:string>>"
    prs = spark.createDataFrame(
        [
            (1, at(2), None, None, [("a", "2024-01-01T00:00:00", "Y"), ("b", "bad", "")]),
            (2, at(2), at(2, 6), at(3), [("c", "2024-01-01T12:00:00", "Y")]),
            (3, at(2), None, None, None), (4, at(2), None, None, []), (5, at(2), None, None, [("d", None, None)]),
        ],
        f"id int, pr_created_datetime {NTZ}, first_pr_review_submitted_datetime {NTZ}, pr_merged_datetime {NTZ}, pr_commits {kind}",
    )
    got = rows(ac.pr_stages(prs).withColumn("c", ac.pr_class()), "id", "c", "coding_seconds", "pickup_seconds", "merge_seconds")
    assert got == [
        (1, "Mixed", 86400, None, None), (2, "Copilot", 43200, 21600, 86400), (3, "Non-Copilot", None, None, None),
        (4, "Non-Copilot", None, None, None), (5, "Non-Copilot", None, None, None),
    ]
    commits = spark.createDataFrame([("a",), ("x",), ("c",)], "commit_id string")
    assert rows(ac.direct_commits(commits, prs)) == [("x",)]


def test_ai_assisted_commits_count_every_flag_spelling(spark, rows):
    fact = spark.createDataFrame([("o", "1", "Y"), ("o", "2", "true"), ("o", "2", "true"), ("o", "3", None), ("o", None, "Y")], "org_name string, commit_id string, copilot_commit_flag string")
    assert rows(fw.ai_assisted_commits(fact)) == [("o", 3, 2)]


def test_secret_totals_are_not_repeated_per_issue(spark, rows):
    scans = spark.createDataFrame([("s1", "r", "f", 5), ("s2", "r", "f", 2)], "scan_id string, repository string, flow_name string, total_issues int")
    issues = spark.createDataFrame([("s1",)] * 5 + [("zz",)], "scan_id string")
    assert rows(ql.secret_summary(scans, issues)) == [("r", "f", 2, 7, 5)]


def test_scan_pair_needs_a_scan_in_the_window(spark, rows):
    scans = [("o", "A", "m", date(2024, 1, d)) for d in (1, 5, 9, 20)] + [("o", "b", "m", date(2023, 1, 1)), ("o", "c", "m", date(2024, 1, 9))]
    df = spark.createDataFrame(scans, "org_name string, project_name string, branch string, last_analysis_date date")
    df = df.withColumn("source_record_insert_datetime", F.col("last_analysis_date").cast(NTZ))
    names = spark.createDataFrame([("a",), ("B",), (None,)], "project_name string")
    got = rows(ql.scan_pair(df, names, "2024-01-03", "2024-01-10"), "project_name", "time_period", "last_analysis_date")
    assert got == [("A", "current", date(2024, 1, 9)), ("A", "previous", date(2024, 1, 5))]


def test_severities(spark, rows):
    df = spark.createDataFrame([(1, [("low",), ("Critical",)]), (2, []), (3, None), (4, [(None,), ("odd",)])], "id int, cve array<struct<severity:string>>")
    assert rows(df.select("id", ql.highest_severity("cve").alias("t"))) == [(1, "CRITICAL"), (2, "LOW"), (3, "LOW"), (4, "INFO")]


def test_backlog_and_outliers(spark, rows):
    alerts = [("o", at(d), None, None) for d in range(1, 8)] + [("o", at(9), at(9), None)] * 2 + [("o", at(1), at(3), at(2))]
    df = spark.createDataFrame(alerts, f"organization string, created_at {NTZ}, fixed_at {NTZ}, dismissed_at {NTZ}")
    got = {r[0]: r[1] for r in rows(ql.open_backlog(df), "day", "open_alerts")}
    assert got[date(2024, 1, 1)] == 2 and got[date(2024, 1, 2)] == 2 and got[date(2024, 1, 9)] == 7
    assert rows(ql.volume_outliers(df), "day", "alerts", "baseline") == [(date(2024, 1, 9), 2, 1.14)]


def test_unreadable_site_times_give_no_finding(spark, rows):
    scans = spark.createDataFrame(
        [("w1", "S", "u", "/p", "Complete", 1, at(5), "05/01/2024 01:00 PM"), ("w2", "S", "u", "/q", "Complete", 2, at(5), "soon"), ("w1", "S", "u", "/old", "Complete", 0, at(4), "04/01/2024 01:00 AM")],
        f"WebsiteId string, WebsiteName string, TargetUrl string, TargetPath string, State string, scan_id int, InitiatedAt {NTZ}, InitiatedTime string",
    )
    issues = spark.createDataFrame(
        [("w1", "t", "High", True, "05/01/2024 01:00 PM"), ("w1", "t2", "High", True, "05/01/2024 11:00 AM"), ("w1", "t3", "Information", True, "06/01/2024 11:00 AM"), ("w2", "t", "High", True, "06/01/2024 11:00 AM"), ("w1", "t4", "High", False, "06/01/2024 11:00 AM")],
        "WebsiteId string, Title string, Severity string, IsPresent boolean, LastSeenDate string",
    )
    filt = spark.createDataFrame([(["S"],)], "project_name array<string>")
    assert rows(ql.web_findings(scans, issues, filt, "2024-01-01", "2024-01-31"), "path_url", "Title") == [("u/p", "t")]


def test_validate_reports_each_broken_rule(spark, rows):
    df = spark.createDataFrame([(1, 5, 3), (2, 1, 3), (3, None, 3)], "id int, a int, b int")
    rules = {"a_within_b": F.col("a") <= F.col("b"), "a_is_small": F.col("a") < 4}
    assert rows(fw.validate(df, rules, ["id"])) == [(1, "a_is_small"), (1, "a_within_b")]


def test_badges_list_every_issue_and_count_unnamed_steps(spark, rows):
    commits = spark.createDataFrame([("only commits", "c1"), ("named", "c2"), ("named", "c2")], "ticket_key string, commit_id string")
    prs = spark.createDataFrame([("only a request", "p1"), (None, "p2")], "ticket_key string, pr_id string")
    steps = spark.createDataFrame(
        [("unnamed", "r1", None, "Deploy"), ("unnamed", "r1", None, None), ("named", "r2", "Sonar", None), ("named", "r3", "x", "release train")],
        "ticket_key string, pipeline_id string, pipeline_step_name string, pipeline_step_type string",
    )
    issues = spark.createDataFrame(
        [("named", "s1", "Bug", "Done", "P1"), ("named", "s2", "Bug", "Done", "P1"), ("not in the flow", "s1", "Bug", "Done", "P1")],
        "issue_key string, sprint_name string, issue_type string, issue_status string, issue_project string",
    )
    out = fw.stage_badges(fw.build_flow_fact(commits, prs, steps, issues))
    got = {r[0]: {c for c, v in zip(out.columns[1:], r[1:], strict=True) if v} for r in rows(out)}
    assert got == {
        "only commits": set(), "only a request": set(), None: set(), "unnamed": {"has_deploy"}, "named": {"has_quality", "has_production"},
    }
    assert out.count() == 5 and all(v is not None for r in rows(out) for v in r[1:])


def test_silent_instances_do_not_count(spark, rows):
    inst = spark.createDataFrame([("i1", "e", 10, 5), ("i2", "e", 90, 1)], "instance_id string, environment string, max_slots int, reserved_slots int")
    nodes = spark.createDataFrame([("i1", at(1, 1)), ("i1", at(1, 2)), ("i2", at(2))], f"instance_id string, create_time {NTZ}")
    got = rows(tm.slot_utilisation(inst, nodes, "day"), "period", "slot_utilisation_percent", "capacity_headroom")
    assert got == [(date(2024, 1, 1), 50.0, 5), (date(2024, 1, 2), 1.11, 89)]
