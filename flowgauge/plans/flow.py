"""Queries over the value stream, releases and platform telemetry."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgauge.operators import flow as fw
from flowgauge.operators import release as rl
from flowgauge.operators import telemetry as tm
from flowgauge.plans.registry import query, rnd, secs

USES = "flow_commits flow_prs flow_steps issues"
FACT = """(SELECT e.*, i.sprint_name AS jira_sprint, i.issue_type AS jira_issue_type, i.issue_status AS jira_status, i.issue_project AS project_name
  FROM (SELECT * FROM flow_commits UNION ALL BY NAME SELECT * FROM flow_prs UNION ALL BY NAME SELECT * FROM flow_steps) e
  LEFT JOIN issues i ON e.ticket_key = i.issue_key)"""


def events(t):
    return fw.stacked(t.flow_commits, t.flow_prs, t.flow_steps)


def fact(t):
    return fw.build_flow_fact(t.flow_commits, t.flow_prs, t.flow_steps, t.issues)


@query("issue_stream", "V1", USES, """
SELECT e.* EXCLUDE (ticket_key), (SELECT issue_project FROM issues WHERE issue_key = 'ISS-157') AS project_name FROM (
  SELECT ticket_key, 'commit' AS data_type, commit_id AS id, commit_timestamp AS at, commit_author AS author, commit_title AS title,
    copilot_commit_flag IS NOT NULL AS ai_assisted, commit_lines_added AS lines_added, commit_lines_removed AS lines_removed,
    commit_lines_modified AS lines_modified, org_name FROM flow_commits
  UNION ALL BY NAME
  SELECT pipeline_step_type AS data_type, ticket_key, pipeline_started_at AS at, pipeline_id AS id, pipeline_step_name AS title, pipeline_step_type AS step_type,
    pipeline_step_conclusion AS step_conclusion, org_name FROM flow_steps
  UNION ALL BY NAME
  SELECT ticket_key, org_name, 'pr' AS data_type, pr_title AS title, pr_user_name AS author, pr_state AS step_type, pr_id AS id, pr_created_datetime AS at FROM flow_prs) e
WHERE ticket_key = 'ISS-157'""")
def _(t):
    return fw.issue_stream(t.flow_commits, t.flow_prs, t.flow_steps, t.issues, "ISS-157")


@query("top_issues_by_flow", "V2", USES, """
SELECT n.issue_key, s.sprint_name AS sprint, n.flow_refs, n.commit_count, n.pr_count FROM (
  SELECT issue_key, CAST(sum(refs) AS BIGINT) AS flow_refs, CAST(sum(c) AS BIGINT) AS commit_count, CAST(sum(p) AS BIGINT) AS pr_count FROM (
    FROM flow_commits SELECT ticket_key AS issue_key, count(*) AS refs, count(DISTINCT commit_id) AS c, 0 AS p GROUP BY ALL
    UNION ALL FROM flow_prs SELECT ticket_key, count(*), 0, count(DISTINCT pr_id) GROUP BY ALL
    UNION ALL FROM flow_steps SELECT ticket_key, count(*), 0, 0 GROUP BY ALL) GROUP BY issue_key) n
LEFT JOIN issues s ON s.issue_key = n.issue_key ORDER BY n.flow_refs DESC, n.issue_key LIMIT 50""")
def _(t):
    return fw.top_issues(events(t), t.issues, 50)


@query("entity_counts_of_issue", "V3", USES, f"""
SELECT count(*) AS total_rows, count(DISTINCT commit_id) AS distinct_commits, count(DISTINCT pr_id) AS distinct_prs,
  count(DISTINCT pipeline_id) AS distinct_runs FROM {FACT} WHERE ticket_key = 'ISS-157'""")
def _(t):
    return fw.entity_counts(events(t), "ISS-157")


@query("flow_fact_profile", "V4", USES, f"""
SELECT jira_issue_type, jira_status, count(*) AS n_rows, count(commit_id) AS commits, count(pr_id) AS prs, count(pipeline_id) AS steps,
  CAST(sum(commit_lines_added) AS BIGINT) AS lines_added FROM {FACT} GROUP BY jira_issue_type, jira_status""")
def _(t):
    return fact(t).groupBy("jira_issue_type", "jira_status").agg(
        F.count("*").alias("n_rows"), F.count("commit_id").alias("commits"), F.count("pr_id").alias("prs"),
        F.count("pipeline_id").alias("steps"), F.sum("commit_lines_added").alias("lines_added"),
    )


@query("issues_by_sprint_label", "V5", "issues", """
SELECT CASE WHEN CAST(issue_created AS DATE) < DATE '1996-01-01' THEN 'Before Sprint 1'
  ELSE concat('Sprint ', date_diff('day', DATE '1996-01-01', CAST(issue_created AS DATE)) // 14 + 1) END AS sprint,
  count(*) AS issues FROM issues GROUP BY sprint""")
def _(t):
    label = fw.sprint_label(F.to_date("issue_created"), "1996-01-01", 14)
    return t.issues.groupBy(label.alias("sprint")).agg(F.count("*").alias("issues"))


@query("usage_rule_violations", "V6", "assist", """
SELECT org_name, rule, count(*) AS n FROM (SELECT org_name, 'accepted_within_generated' AS rule FROM assist WHERE code_acceptance_activity_count > code_generation_activity_count
  UNION ALL SELECT org_name, 'added_within_suggested' FROM assist WHERE loc_added_sum > loc_suggested_to_add_sum
  UNION ALL SELECT org_name, 'deleted_within_suggested' FROM assist WHERE loc_deleted_sum > loc_suggested_to_delete_sum
  UNION ALL SELECT org_name, 'small_acceptance' FROM assist WHERE code_acceptance_activity_count > 100) GROUP BY org_name, rule""")
def _(t):
    rules = fw.usage_rules() | {"small_acceptance": F.col("code_acceptance_activity_count") <= 100}
    return fw.validate(t.assist, rules, ["org_name"]).groupBy("org_name", "rule").agg(F.count("*").alias("n"))


@query("failed_steps_with_logs", "V7", f"deploys repo_runs job_logs {USES}", f"""
SELECT d.pipeline_id, d.project_name, d.step_id, r.ticket_key, length(l.logs) AS log_length, (SELECT count(*) FROM {FACT} f WHERE f.ticket_key = r.ticket_key) AS flow_rows
FROM deploys d JOIN repo_runs r ON d.pipeline_id = r.pipeline_id AND d.project_name = r.project_name JOIN job_logs l ON l.job = d.step_id
WHERE d.step_conclusion = 'failure' AND d.step_id IS NOT NULL AND CAST(r.pipeline_started_at AS DATE) BETWEEN DATE '2001-06-30' - 900 AND DATE '2001-06-30'""")
def _(t):
    out = fw.failed_steps(t.deploys, t.repo_runs, t.job_logs, events(t), "2001-06-30", 900)
    return out.select("pipeline_id", "project_name", "step_id", "ticket_key", "log_length", "flow_rows")


@query("distinct_failures_by_project", "V8", "deploys", """
SELECT project_name, count(*) AS rows, count(DISTINCT (step_id, project_name)) AS failures FROM deploys WHERE step_conclusion = 'failure' GROUP BY project_name""")
def _(t):
    return fw.distinct_failures(t.deploys)


@query("recent_failures_by_team", "V9", "deploys", """
SELECT team, project_name, count(*) AS n FROM deploys WHERE step_conclusion = 'failure'
AND CAST(pipeline_started_at AS DATE) BETWEEN DATE '2001-06-30' - 400 AND DATE '2001-06-30' GROUP BY team, project_name""")
def _(t):
    return fw.recent_failures(t.deploys, "team", "2001-06-30", 400)


def word_sql(*words):
    return "bool_or(regexp_matches(lower(concat_ws(' ', pipeline_step_type, pipeline_step_name)), '" + "|".join(words) + "'))"


# The stages' words are spelled out here, so that a wrong pattern of the operator does not pass on both sides.
@query("stage_badges_by_issue", "V10", USES, f"""
SELECT ticket_key, {word_sql('review')} AS has_code_review, {word_sql('build', 'compile')} AS has_ci, {word_sql('security', 'scan')} AS has_security,
  {word_sql('quality', 'sonar')} AS has_quality, {word_sql('test', 'qa')} AS has_qa, {word_sql('deploy')} AS has_deploy,
  {word_sql('production', 'release')} AS has_production FROM {FACT} GROUP BY ticket_key""")
def _(t):
    return fw.stage_badges(fact(t))


@query("ai_assisted_commits", "V11", USES, """
SELECT org_name, count(DISTINCT commit_id) AS commits, count(DISTINCT CASE WHEN copilot_commit_flag IN ('Y', 'true') THEN commit_id END) AS ai_assisted_commits
FROM (SELECT * FROM flow_commits UNION ALL BY NAME SELECT * FROM flow_prs UNION ALL BY NAME SELECT * FROM flow_steps) GROUP BY org_name""")
def _(t):
    return fw.ai_assisted_commits(events(t))


# ---- releases ------------------------------------------------------------------------------------------------------


def objects(column):
    return f"(SELECT fix_version, unnest({column}) AS j FROM releases)"


def text(field):
    return f"(j ->> '$.{field}')"


def at(field):
    return f"CAST({text(field)} AS TIMESTAMP)"


@query("release_objects_unpacked", "R1", "releases", f"""
SELECT fix_version, {text('pipeline_id')} AS pipeline_id, {text('pipeline_group')} AS pipeline_group, {text('pipeline_status')} AS pipeline_status,
  CAST({text('ltfc_seconds')} AS BIGINT) AS ltfc_seconds FROM {objects('deployments')}""")
def _(t):
    rows = rl.unpack(t.releases, "deployments")
    return rows.select("fix_version", "pipeline_id", "pipeline_group", "pipeline_status", "ltfc_seconds")


@query("release_issue_completion", "R2", "releases", f"""
SELECT fix_version, count(*) AS total_issues, count(*) FILTER ({text('is_done')} = 'true') AS done_issues,
  {rnd(f"count(*) FILTER ({text('is_done')} = 'true') * 100.0 / count(*)")} AS done_percent,
  CAST(median(CASE WHEN {text('is_done')} = 'true' THEN CAST({text('current_time')} AS BIGINT) END) AS DOUBLE) AS median_cycle_seconds FROM {objects('issues')} GROUP BY fix_version""")
def _(t):
    return rl.issue_completion(t.releases)


@query("release_defect_ratio", "R3", "releases", f"""
SELECT fix_version, count(*) AS issues, count(*) FILTER ({text('isdefect')} = 'true') AS defects,
  {rnd(f"count(*) FILTER ({text('isdefect')} = 'true') * 100.0 / count(*)")} AS defect_percent FROM {objects('defects')} GROUP BY fix_version""")
def _(t):
    return rl.defect_ratio(t.releases)


@query("release_deployment_health", "R4", "releases", f"""
SELECT fix_version, {text('pipeline_group')} AS environment, count(*) AS runs, {rnd(f"count(*) FILTER ({text('pipeline_status')} = 'success') * 100.0 / count(*)")} AS success_percent,
  {rnd(f"sum({secs(at('pipeline_started_at'), at('pipeline_finished_at'))}) * 1.0 / count(*)")} AS mean_duration_seconds,
  {rnd(f"sum(CAST({text('ltfc_seconds')} AS BIGINT)) * 1.0 / count(*)")} AS mean_lead_seconds FROM {objects('deployments')} GROUP BY fix_version, environment""")
def _(t):
    return rl.deployment_health(t.releases)


@query("release_review_hours", "R5", "releases", f"""
SELECT fix_version, count(*) AS pull_requests, {rnd('sum(a) / (count(a) * 3600.0)')} AS review_hours, {rnd('sum(b) / (count(b) * 3600.0)')} AS merge_hours
FROM (SELECT fix_version, {secs(at('pr_created_datetime'), at('latest_pr_review_submitted_datetime'))} AS a,
  {secs(at('pr_created_datetime'), at('pr_merged_datetime'))} AS b FROM {objects('pull_requests')}) GROUP BY fix_version""")
def _(t):
    return rl.review_hours(t.releases)


def rate_sql(column, kind, status):
    return f"""SELECT fix_version, '{kind}' AS kind, {text('tool_type')} AS tool_type, count(*) AS runs,
      {rnd(f"count(*) FILTER ({text(status)} = 'success') * 100.0 / count(*)")} AS pass_percent FROM {objects(column)} GROUP BY fix_version, tool_type"""


query("release_pass_rates", "R6", "releases", f"{rate_sql('builds', 'build', 'build_status')} UNION ALL {rate_sql('gates', 'gate', 'step_status')}")(
    lambda t: rl.pass_rates(t.releases)
)


@query("release_open_risks", "R7", "releases", f"""
SELECT fix_version, coalesce(vulnerabilities, 0) AS vulnerabilities, coalesce(resolved_vulnerabilities, 0) AS resolved_vulnerabilities,
  coalesce(open_web_findings, 0) AS open_web_findings, coalesce(open_bugs, 0) AS open_bugs, mean_bug_age_days
FROM (SELECT fix_version, count(*) AS vulnerabilities, count(*) FILTER ({text('last_activity_date')} > {text('activity_date')}) AS resolved_vulnerabilities
  FROM {objects('vulnerabilities')} GROUP BY fix_version) FULL JOIN (SELECT fix_version, count(*) FILTER ({text('IsPresent')} = 'true' AND {text('IsAddressed')} = 'false') AS open_web_findings
  FROM {objects('web_vulnerabilities')} GROUP BY fix_version) USING (fix_version) FULL JOIN (SELECT fix_version, count(*) FILTER ({text('status')} = 'OPEN') AS open_bugs,
  {rnd(f"sum(CASE WHEN {text('status')} = 'OPEN' THEN date_diff('day', CAST({text('creation_date')} AS DATE), DATE '2002-01-01') END) * 1.0 / nullif(count(*) FILTER ({text('status')} = 'OPEN'), 0)")} AS mean_bug_age_days
  FROM {objects('bugs')} GROUP BY fix_version) USING (fix_version)""")
def _(t):
    return rl.open_risks(t.releases, "2002-01-01")


def total(field):
    return f"sum(TRY_CAST({text(field)} AS INTEGER))"


@query("release_test_totals", "R8", "releases", f"""
SELECT fix_version, {', '.join(f'CAST({total(c)} AS BIGINT) AS {c}' for c in ('total_tests', 'success_tests', 'failed_tests', 'skipped_tests'))},
  {rnd(f"CAST({total('success_tests')} AS DOUBLE) * 100 / {total('total_tests')}")} AS pass_percent FROM {objects('tests')} GROUP BY fix_version""")
def _(t):
    return rl.test_totals(t.releases)


@query("releases_of_levels", "R9", "releases", """
SELECT level_value, fix_version, release_status, max(release_date) AS release_date, count(*) AS n_rows FROM releases
WHERE level_name = 'level_3' AND level_value IN ('NATION_2', 'NATION_7') GROUP BY level_value, fix_version, release_status""")
def _(t):
    return rl.releases_of_levels(t.releases, ["NATION_2", "NATION_7"])


@query("release_rows_per_level", "R9", "releases", "SELECT level_name, level_value, count(*) AS n_rows FROM releases GROUP BY level_name, level_value")
def _(t):
    return rl.rows_per_level(t.releases)


# ---- telemetry -----------------------------------------------------------------------------------------------------

SLOTS = """SELECT {0} AS period, environment, CAST(sum(reserved_slots) AS BIGINT) AS reserved_slots, CAST(sum(max_slots) AS BIGINT) AS max_slots,
  {1} AS slot_utilisation_percent, CAST(sum(max_slots) - sum(reserved_slots) AS BIGINT) AS capacity_headroom
FROM (SELECT DISTINCT CAST(create_time AS DATE) AS day, instance_id FROM nodes) JOIN instances USING (instance_id) GROUP BY period, environment"""

for name, grain, expr in (
    ("slot_utilisation_daily", "day", "day"),
    ("slot_utilisation_monthly", "month", "CAST(date_trunc('month', day) AS DATE)"),
):
    query(name, "P1", "nodes instances", SLOTS.format(expr, rnd("CAST(sum(reserved_slots) AS DOUBLE) * 100 / sum(max_slots)")))(
        lambda t, grain=grain: tm.slot_utilisation(t.instances, t.nodes, grain)
    )


@query("memory_and_cores_monthly", "P2", "nodes instances", f"""
SELECT CAST(date_trunc('month', create_time) AS DATE) AS period, environment, {rnd('CAST(sum(jvm_max_mem_gb) AS DOUBLE) * 100 / sum(total_memory_gb)')} AS jvm_memory_percent,
  CAST(sum(cpu_cores) AS BIGINT) AS cpu_cores FROM nodes JOIN instances USING (instance_id) GROUP BY period, environment""")
def _(t):
    return tm.memory_and_cores(t.instances, t.nodes, "month")


@query("activity_by_type_and_user", "P3", "activities", "SELECT event_type, by_whom, count(*) AS n FROM activities GROUP BY event_type, by_whom")
def _(t):
    return tm.activity_by_type(t.activities)


@query("new_users_by_week", "P3", "activities", """
SELECT CAST(date_trunc('week', f) AS DATE) AS week, count(*) AS new_users FROM (SELECT by_whom, min(create_time) AS f FROM activities GROUP BY by_whom) GROUP BY week""")
def _(t):
    return tm.users_by_first_week(t.activities)


for column in ("environment", "org_name"):
    query(f"instances_by_{column}", "P4", "instances", f"SELECT {column}, count(*) AS instances FROM instances GROUP BY {column}")(
        lambda t, column=column: tm.instance_counts(t.instances, column)
    )
