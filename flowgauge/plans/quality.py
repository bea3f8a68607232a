"""Queries over code quality, security findings and unit tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgauge.operators import filters as fl
from flowgauge.operators import quality as ql
from flowgauge.plans.registry import query, rnd
from flowgauge.plans.scope import flat, rows

WINDOW = ("2000-01-01", "2001-06-30")


def names(t, **levels):
    return fl.scope_values(rows(t), "project_name", "kpi-quality", **levels)


NAMES = "SELECT lower(n) AS n FROM (SELECT unnest(project_name) AS n FROM flat WHERE kpi = 'kpi-quality')"
PRIMARY = f"""SELECT DISTINCT org_name, project_name, branch FROM sonar_measures WHERE lower(project_name) IN ({NAMES})
  AND last_analysis_date BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}'"""
# The two newest analyses of each branch up to the window's end, as a sorted list of days, for branches analysed inside it.
PAIR = f"""SELECT m.*, CASE WHEN m.last_analysis_date = n.days[1] THEN 'current' ELSE 'previous' END AS time_period
  FROM (SELECT org_name, project_name, branch, list_reverse_sort(list(last_analysis_date))[1:2] AS days FROM sonar_measures
    WHERE last_analysis_date <= DATE '{WINDOW[1]}' GROUP BY ALL HAVING max(last_analysis_date) >= DATE '{WINDOW[0]}') n
  JOIN sonar_measures m USING (org_name, project_name, branch) WHERE list_contains(n.days, m.last_analysis_date) AND lower(m.project_name) IN ({NAMES})"""


@query("scan_pairs", "Q1", "flat sonar_measures", f"""
SELECT org_name, project_name, branch, time_period, last_analysis_date FROM ({PAIR})""")
def _(t):
    pair = ql.scan_pair(t.sonar_measures, names(t), *WINDOW)
    return pair.select("org_name", "project_name", "branch", "time_period", "last_analysis_date")


@query("projects_scanned_in_window", "Q2", "flat sonar_measures", PRIMARY)
def _(t):
    return ql.active_projects(t.sonar_measures, names(t), *WINDOW)


@query("scan_ratings", "Q3", "flat sonar_measures sonar_issues", f"""
SELECT p.project_name, p.branch, time_period, type, count(*) AS issue_count, max(project_reliability_rating_value) AS reliability_rating,
  max(project_sqale_rating_value) AS maintainability_rating FROM ({PAIR}) p JOIN sonar_issues i ON i.org_name = p.org_name
  AND i.project = p.project_name AND i.branch = p.branch AND i.source_record_insert_datetime = p.source_record_insert_datetime
WHERE i.status IN ('OPEN', 'REOPENED', 'CONFIRMED') GROUP BY p.project_name, p.branch, time_period, type""")
def _(t):
    return ql.sonar_ratings(t.sonar_issues, ql.scan_pair(t.sonar_measures, names(t), *WINDOW))


@query("issues_of_newest_scans", "Q4", "sonar_issues", """
SELECT project, type, count(*) AS n FROM sonar_issues WHERE (org_name, project, branch, source_record_insert_datetime) IN (
  SELECT (org_name, project, branch, max(source_record_insert_datetime)) FROM sonar_issues GROUP BY org_name, project, branch) GROUP BY project, type""")
def _(t):
    return ql.issues_of_newest_scan(t.sonar_issues).groupBy("project", "type").agg(F.count("*").alias("n"))


NEWEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY org_name, project_name, branch ORDER BY source_record_insert_datetime DESC) AS rn
  FROM sonar_measures) WHERE rn = 1"""
COVER = rnd("CAST(project_lines_to_cover_value - project_uncovered_lines_value AS DOUBLE) * 100 / nullif(project_lines_to_cover_value, 0)", 1)
GOOD = " AND ".join(f"project_{k}_rating_value IN ('1.0', '2.0')" for k in ("reliability", "security", "sqale"))


@query("newest_measures_with_gate", "Q5 Q7 Q8", "sonar_measures", f"""
SELECT org_name, project_name, branch, project_bugs_value, {COVER} AS line_coverage, CASE WHEN {GOOD} THEN 'OK' ELSE 'ERROR' END AS gate FROM ({NEWEST})""")
def _(t):
    return ql.newest_measures(t.sonar_measures).select(
        "org_name", "project_name", "branch", "project_bugs_value", ql.line_coverage().alias("line_coverage"),
        ql.quality_gate().alias("gate"),
    )


@query("measures_aligned_with_issues", "Q6", "sonar_measures sonar_issues", """
SELECT m.org_name, m.project_name, count(*) AS n_matches FROM sonar_measures m JOIN sonar_issues i ON m.org_name = i.org_name
  AND m.project_name = i.project AND m.branch = i.branch AND m.source_record_insert_datetime = i.source_record_insert_datetime
GROUP BY m.org_name, m.project_name""")
def _(t):
    return ql.key_alignment(t.sonar_measures, t.sonar_issues)


@query("coverage_trend", "Q7", "sonar_measures", f"""
SELECT org_name, project_name, branch, last_analysis_date, {COVER} AS line_coverage FROM sonar_measures""")
def _(t):
    return t.sonar_measures.select("org_name", "project_name", "branch", "last_analysis_date", ql.line_coverage().alias("line_coverage"))


@query("gates_by_organisation", "Q8", "sonar_measures", f"""
SELECT org_name, CASE WHEN {GOOD} THEN 'OK' ELSE 'ERROR' END AS gate, count(*) AS n FROM sonar_measures GROUP BY org_name, gate""")
def _(t):
    return t.sonar_measures.groupBy("org_name", ql.quality_gate().alias("gate")).agg(F.count("*").alias("n"))


@query("defect_density", "Q9", "sonar_measures", f"""
SELECT project_name, branch, org_name, {rnd('CAST(project_bugs_value AS DOUBLE) * 1000 / nullif(project_ncloc_value, 0)')} AS bugs_per_kloc FROM ({NEWEST})""")
def _(t):
    return ql.newest_measures(t.sonar_measures).select(
        "project_name", "branch", "org_name", ql.defect_density().alias("bugs_per_kloc")
    )


@query("scan_history", "Q10", "sonar_measures", """
SELECT org_name, project_name, max(last_analysis_date) AS latest_scan, min(last_analysis_date) AS earliest_scan, count(*) AS n_scans
FROM sonar_measures GROUP BY org_name, project_name""")
def _(t):
    return ql.scan_history(t.sonar_measures)


@query("container_vulnerabilities", "Q11", "container_scans", """
SELECT project_name, lower(c.severity) AS severity, count(*) AS n_cves, count(DISTINCT c.identifier) AS distinct_cves FROM (
  SELECT project_name, unnest(cve) AS c FROM container_scans WHERE (unique_sha_id, activity_date) IN (
    SELECT (unique_sha_id, max(activity_date)) FROM container_scans GROUP BY unique_sha_id)) GROUP BY project_name, lower(c.severity)""")
def _(t):
    return ql.container_cves(t.container_scans)


@query("container_components", "Q12", "container_scans", """
SELECT project_name, severity, count(*) AS n_components, CAST(coalesce(sum(len(cve)), 0) AS BIGINT) AS n_cves FROM container_scans
GROUP BY project_name, severity""")
def _(t):
    return ql.component_counts(t.container_scans)


@query("highest_container_severity", "Q13", "container_scans", """
SELECT component_sha_id, array_to_string(list_sort(list_distinct(list_transform(cve, lambda c: upper(c.severity)))), ',') AS severities,
  CASE coalesce(list_max(list_transform(cve, lambda c: CASE lower(c.severity) WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2
    WHEN 'low' THEN 1 ELSE 0 END)), 1) WHEN 4 THEN 'CRITICAL' WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' ELSE 'INFO' END AS top
FROM container_scans""")
def _(t):
    return t.container_scans.select(
        "component_sha_id", F.array_join(ql.severity_set("cve"), ",").alias("severities"), ql.highest_severity("cve").alias("top")
    )


WEB_SEEN = "try_strptime(i.LastSeenDate, '%d/%m/%Y %I:%M %p') >= try_strptime(n.scan.InitiatedTime, '%d/%m/%Y %I:%M %p')"
# Each site's newest finished scan as one struct, then the findings that were still seen when it began.
WEB = f"""SELECT DISTINCT n.scan.WebsiteName AS WebsiteName, n.scan.TargetUrl || n.scan.TargetPath AS path_url, i.Severity, i.Title, i.LastSeenDate, n.scan.InitiatedTime AS InitiatedTime
  FROM web_issues i JOIN (
    SELECT WebsiteId, arg_max(struct_pack(WebsiteName, TargetUrl, TargetPath, InitiatedTime, InitiatedAt), (InitiatedAt, scan_id)) AS scan FROM web_scans
    WHERE State = 'Complete' AND WebsiteName IN (SELECT unnest(project_name) FROM flat WHERE kpi = 'kpi-web') GROUP BY WebsiteId) n USING (WebsiteId)
  WHERE n.scan.InitiatedAt::DATE >= DATE '{WINDOW[0]}' AND n.scan.InitiatedAt::DATE <= DATE '{WINDOW[1]}' AND i.IsPresent
    AND i.Severity IN (SELECT DISTINCT Severity FROM web_issues EXCEPT VALUES ('Information'), ('BestPractice')) AND {WEB_SEEN}"""


def web(t):
    filt = flat(t, "project_name").filter(fl.in_scope("kpi-web"))
    return ql.web_findings(t.web_scans, t.web_issues, filt, *WINDOW)


query("web_findings", "Q14", "flat web_scans web_issues", WEB)(web)


@query("web_findings_by_severity", "Q15", "flat web_scans web_issues", f"""
SELECT WebsiteName, Severity, count(*) AS n FROM ({WEB}) GROUP BY WebsiteName, Severity""")
def _(t):
    return web(t).groupBy("WebsiteName", "Severity").agg(F.count("*").alias("n"))


STATE = "CASE WHEN fixed_at IS NOT NULL THEN 'fixed' WHEN dismissed_at IS NOT NULL THEN 'dismissed' ELSE 'open' END"


@query("alert_counts", "Q16", "alerts", f"""
SELECT organization, severity, {STATE} AS state, count(*) AS n FROM alerts GROUP BY organization, severity, state""")
def _(t):
    return t.alerts.groupBy("organization", "severity", ql.alert_state().alias("state")).agg(F.count("*").alias("n"))


@query("alert_days_to_fix", "Q17", "alerts", f"""
SELECT repository_name, severity, count(fixed_at) AS fixed, {rnd("sum(date_diff('day', created_at, fixed_at)) * 1.0 / count(fixed_at)")} AS mean_days
FROM alerts GROUP BY repository_name, severity""")
def _(t):
    from flowgauge.functions.columns import ratio

    return t.alerts.groupBy("repository_name", "severity").agg(
        F.count("fixed_at").alias("fixed"), F.round(ratio(F.sum(ql.days_to_fix()), F.count("fixed_at")), 2).alias("mean_days")
    )


@query("alert_backlog_by_day", "Q17", "alerts", """
WITH e AS (SELECT organization, CAST(created_at AS DATE) AS day, 1 AS d FROM alerts UNION ALL
  SELECT organization, CAST(least(fixed_at, dismissed_at) AS DATE), -1 FROM alerts WHERE least(fixed_at, dismissed_at) IS NOT NULL),
g AS (SELECT organization, day, CAST(sum(d) AS BIGINT) AS change FROM e GROUP BY organization, day)
SELECT *, CAST(sum(change) OVER (PARTITION BY organization ORDER BY day) AS BIGINT) AS open_alerts FROM g""")
def _(t):
    return ql.open_backlog(t.alerts)


@query("test_results_by_repository", "Q18", "test_runs", f"""
SELECT repository, count(*) AS n_runs, {', '.join(f'CAST(sum({k}_tests) AS BIGINT) AS total_{k}' for k in ('passed', 'failed', 'errored', 'skipped'))},
  {rnd('CAST(sum(passed_tests) AS DOUBLE) * 100 / sum(total_tests)')} AS pass_percent FROM test_runs GROUP BY repository""")
def _(t):
    return ql.test_rollup(t.test_runs)


def drilldown_sql(region):
    """Each run's distinct test rows, marked by one pass over the runs: listed repository, wanted tag, or any tag."""
    listed = f"""(SELECT unnest(v.filter_values) FROM filter_values v JOIN filter_groups g USING (filter_group_id)
      WHERE v.active AND g.active AND list_contains(v.kpi_uuids, 'kpi-tests') AND g.level_1 = '{region}' AND v.filter_name = '{{0}}')"""
    return f"""
WITH urls(u) AS {listed.format('project_url')}, tags(g) AS {listed.format('pipeline_tags')}
SELECT pipeline_id, pipeline_name, step_id, step_name, run_count, count(*) AS n FROM (
  SELECT DISTINCT r.* FROM test_runs r WHERE r.created_at::DATE >= DATE '{WINDOW[0]}' AND r.created_at::DATE <= DATE '{WINDOW[1]}'
    AND ((r.git_url <> '' AND r.git_url IN (SELECT u FROM urls)) OR (SELECT bool_or(g IS NULL) FROM tags)
      OR list_has_any(r.pipeline_tags, (SELECT list(g) FROM tags)))) GROUP BY ALL"""


def drilldown(t, region):
    urls = fl.scope_values(rows(t), "project_url", "kpi-tests", level_1=region)
    tags = fl.scope_values(rows(t), "pipeline_tags", "kpi-tests", level_1=region)
    return ql.test_drilldown(t.test_runs, urls, tags, *WINDOW)


USED = "filter_groups filter_values test_runs"
query("test_drilldown", "Q19", USED, drilldown_sql("ASIA"))(lambda t: drilldown(t, "ASIA"))
# One group of this region lists a NULL tag: any tag will do.
query("test_drilldown_any_tag", "Q19", USED, drilldown_sql("AFRICA"))(lambda t: drilldown(t, "AFRICA"))


@query("secret_scan_summary", "Q20", "secret_scans secret_issues", """
SELECT repository, flow_name, count(*) AS n_scans, CAST(sum(total_issues) AS BIGINT) AS sum_total_issues,
  CAST(coalesce(sum((SELECT count(*) FROM secret_issues i WHERE i.scan_id = s.scan_id)), 0) AS BIGINT) AS n_issue_rows FROM secret_scans s
GROUP BY repository, flow_name""")
def _(t):
    return ql.secret_summary(t.secret_scans, t.secret_issues)


@query("test_executions_by_status", "Q21", "test_tickets", """
SELECT project_name, status.name AS status, status.final AS final, count(*) AS executions, CAST(coalesce(sum(len(tickets)), 0) AS BIGINT) AS tickets
FROM test_tickets GROUP BY project_name, status.name, status.final""")
def _(t):
    return ql.execution_status(t.test_tickets)


@query("test_tickets_by_type", "Q21", "test_tickets", """
SELECT project_name, status, k.issue_type AS issue_type, count(*) AS n FROM (SELECT project_name, status.name AS status, unnest(tickets) AS k FROM test_tickets)
GROUP BY project_name, status, k.issue_type""")
def _(t):
    return ql.tickets_by_type(t.test_tickets)


@query("alert_volume_outliers", "Q22", "alerts", f"""
WITH d AS (SELECT organization, CAST(created_at AS DATE) AS day, count(*) AS alerts FROM alerts GROUP BY organization, day),
w AS (SELECT *, sum(alerts) OVER b AS s, count(*) OVER b AS n FROM d WINDOW b AS (PARTITION BY organization ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT organization, day, alerts, {rnd('CAST(s AS DOUBLE) / n')} AS baseline FROM w WHERE n = 7 AND alerts * n >= s * 1.5""")
def _(t):
    return ql.volume_outliers(t.alerts)
