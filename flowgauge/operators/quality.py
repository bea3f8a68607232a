"""Code quality, security findings and unit tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions.columns import col, lookup, ratio
from flowgauge.operators.filters import matching_tag_arrays, name_in_arrays
from flowgauge.operators.ordering import latest_per_key, latest_record, running_total, top_rows

SCAN = ("org_name", "project_name", "branch")
OPEN = ("OPEN", "REOPENED", "CONFIRMED")
# Severities from lowest to highest.
SEVERITIES = ("info", "low", "medium", "high", "critical")


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def listed_projects(df: DataFrame, names: DataFrame, column: str = "project_name") -> DataFrame:
    """Rows whose project is listed, ignoring case."""
    wanted = names.select(F.lower("project_name").alias("_name")).distinct()
    return df.join(wanted, F.lower(df[column]) == wanted["_name"], "left_semi")


def active_projects(measures: DataFrame, names: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct (organisation, project, branch) with a scan in the window."""
    inside = measures.filter(F.col("last_analysis_date").between(day(start), day(end)))
    return listed_projects(inside, names).select(*SCAN).distinct()


def scan_pair(measures: DataFrame, names: DataFrame, start: str, end: str) -> DataFrame:
    """The two newest scans up to the end date of each project that was scanned in the window, current and previous.

    A project was scanned in the window exactly if its newest scan up to the end is not before the start, so the
    measures are read once.
    """
    seen = listed_projects(measures.filter(F.col("last_analysis_date") <= day(end)), names)
    order = [F.desc("last_analysis_date"), F.desc("source_record_insert_datetime")]
    pair = top_rows(seen, SCAN, order, 2, "rank")
    newest = F.max("last_analysis_date").over(Window.partitionBy(*SCAN))
    return (
        pair.withColumn("_newest", newest)
        .filter(F.col("_newest") >= day(start))
        .drop("_newest")
        .withColumn("time_period", F.when(F.col("rank") == 1, "current").otherwise("previous"))
    )


def scan_issues(issues: DataFrame, scans: DataFrame, statuses: Sequence[str] = OPEN) -> DataFrame:
    """Open issues of the given scans: equal on organisation, project, branch and record time."""
    kept = issues.filter(F.col("status").isin(list(statuses))).withColumnRenamed("project", "project_name")
    return kept.join(scans, [*SCAN, "source_record_insert_datetime"])


def sonar_ratings(issues: DataFrame, scans: DataFrame) -> DataFrame:
    """Open issues by type, with the worst ratings, for the current and the previous scan."""
    return (
        scan_issues(issues, scans)
        .groupBy("project_name", "branch", "time_period", "type")
        .agg(
            F.count("*").alias("issue_count"),
            F.max("project_reliability_rating_value").alias("reliability_rating"),
            F.max("project_sqale_rating_value").alias("maintainability_rating"),
        )
    )


def issues_of_newest_scan(issues: DataFrame) -> DataFrame:
    """Issue rows of each project's newest scan. All rows of that scan are kept, not one of them."""
    return latest_per_key(issues, ["org_name", "project", "branch"], "source_record_insert_datetime")


def newest_measures(measures: DataFrame) -> DataFrame:
    return latest_record(measures, SCAN, [F.desc("source_record_insert_datetime")])


def key_alignment(measures: DataFrame, issues: DataFrame) -> DataFrame:
    """Measure and issue pairs that agree on all four keys, per project. Issues are counted per key before the join."""
    per_key = (
        issues.withColumnRenamed("project", "project_name")
        .groupBy(*SCAN, "source_record_insert_datetime")
        .agg(F.count("*").alias("n"))
    )
    joined = measures.select(*SCAN, "source_record_insert_datetime").join(per_key, [*SCAN, "source_record_insert_datetime"])
    return joined.groupBy("org_name", "project_name").agg(F.sum("n").alias("n_matches"))


def line_coverage() -> Column:
    """Covered lines in percent of the lines to cover, 1 digit."""
    to_cover, uncovered = F.col("project_lines_to_cover_value"), F.col("project_uncovered_lines_value")
    return F.round(ratio(to_cover - uncovered, to_cover, 100), 1)


def quality_gate() -> Column:
    """OK when reliability, security and maintainability are all A or B."""
    names = ("project_reliability_rating_value", "project_security_rating_value", "project_sqale_rating_value")
    good = [F.col(n).isin("1.0", "2.0") for n in names]
    return F.when(F.coalesce(good[0] & good[1] & good[2], F.lit(False)), "OK").otherwise("ERROR")


def defect_density() -> Column:
    """Bugs per 1000 lines of code."""
    return F.round(ratio(F.col("project_bugs_value"), F.col("project_ncloc_value"), 1000), 2)


def scan_history(measures: DataFrame, keys: Sequence[str] = ("org_name", "project_name")) -> DataFrame:
    return measures.groupBy(*keys).agg(
        F.max("last_analysis_date").alias("latest_scan"),
        F.min("last_analysis_date").alias("earliest_scan"),
        F.count("*").alias("n_scans"),
    )


def container_cves(scans: DataFrame) -> DataFrame:
    """Vulnerabilities of the newest scan of each image, by severity. All components of that scan are kept."""
    newest = latest_per_key(scans, ["unique_sha_id"], "activity_date")
    return (
        newest.select("project_name", F.explode("cve").alias("c"))
        .groupBy("project_name", F.lower("c.severity").alias("severity"))
        .agg(F.count("*").alias("n_cves"), F.count_distinct("c.identifier").alias("distinct_cves"))
    )


def component_counts(scans: DataFrame) -> DataFrame:
    return scans.groupBy("project_name", "severity").agg(
        F.count("*").alias("n_components"),
        F.coalesce(F.sum(F.when(F.col("cve").isNotNull(), F.size("cve"))), F.lit(0)).alias("n_cves"),
    )


def severity_rank(c: str | Column) -> Column:
    """0 for the lowest and for unknown severities."""
    return F.coalesce(lookup(F.lower(col(c)), {s: str(i) for i, s in enumerate(SEVERITIES)}).cast("int"), F.lit(0))


def severity_set(array: str, fields: str = "severity") -> Column:
    """Sorted distinct upper-case severities of an array of structs."""
    return F.array_sort(F.array_distinct(F.transform(array, lambda c: F.upper(c[fields]))))


def highest_severity(array: str, fields: str = "severity", default: str = "LOW") -> Column:
    """Upper-case name of the highest severity in an array of structs; the default when there is none."""
    top = F.array_max(F.transform(array, lambda c: severity_rank(c[fields])))
    names = F.array(*[F.lit(s.upper()) for s in SEVERITIES])
    return F.coalesce(F.get(names, top), F.lit(default))


SITE_TIME = "dd/MM/yyyy hh:mm a"


def site_time(c: str | Column) -> Column:
    """Scanner timestamps are text; text that does not parse gives NULL."""
    return F.try_to_timestamp(col(c), F.lit(SITE_TIME)).cast("timestamp_ntz")


def web_findings(scans: DataFrame, issues: DataFrame, filt: DataFrame, start: str, end: str) -> DataFrame:
    """Present findings, above informational, seen at or after the start of the site's newest complete scan.

    The scan must have started inside the window. Distinct rows per site, path, title, severity and last-seen date.
    """
    complete = name_in_arrays(scans.filter(F.col("State") == "Complete"), filt, "WebsiteName", "project_name")
    newest = latest_record(complete, ["WebsiteId"], [F.desc("InitiatedAt"), F.desc("scan_id")])
    inside = newest.filter(F.to_date("InitiatedAt").between(day(start), day(end))).select(
        "WebsiteId", "WebsiteName", F.concat("TargetUrl", "TargetPath").alias("path_url"), "InitiatedTime"
    )
    found = issues.filter(~F.col("Severity").isin("Information", "BestPractice") & F.col("IsPresent"))
    joined = inside.join(found, "WebsiteId").filter(site_time("LastSeenDate") >= site_time("InitiatedTime"))
    return joined.select("WebsiteName", "path_url", "Severity", "Title", "LastSeenDate", "InitiatedTime").distinct()


def alert_state() -> Column:
    return F.when(F.col("fixed_at").isNotNull(), "fixed").when(F.col("dismissed_at").isNotNull(), "dismissed").otherwise("open")


def days_to_fix() -> Column:
    return F.datediff("fixed_at", "created_at")


def open_backlog(alerts: DataFrame, keys: Sequence[str] = ("organization",)) -> DataFrame:
    """Open alerts at the end of each day on which any was opened or closed.

    Alerts become +1 and -1 marks, summed per day before the running total, whose input is one row per key and day.
    """
    marks = F.array(
        F.struct(F.to_date("created_at").alias("day"), F.lit(1).alias("delta")),
        F.struct(F.to_date(F.least("fixed_at", "dismissed_at")).alias("day"), F.lit(-1).alias("delta")),
    )
    daily = (
        alerts.select(*keys, F.inline(marks)).filter(F.col("day").isNotNull()).groupBy(*keys, "day").agg(F.sum("delta").alias("change"))
    )
    return running_total(daily, keys, "day", "change", "open_alerts")


def test_rollup(runs: DataFrame, keys: Sequence[str] = ("repository",)) -> DataFrame:
    """Runs and summed results, with the pass rate as a ratio of sums."""
    return runs.groupBy(*keys).agg(
        F.count("*").alias("n_runs"),
        *[F.sum(f"{k}_tests").alias(f"total_{k}") for k in ("passed", "failed", "errored", "skipped")],
        F.round(ratio(F.sum("passed_tests"), F.sum("total_tests"), 100), 2).alias("pass_percent"),
    )


def test_drilldown(runs: DataFrame, urls: DataFrame, tags: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct test rows whose repository is listed or whose tags match, per run. A NULL among the wanted tags means any.

    One pass: each row is marked by its repository or its tags and kept if marked.
    """
    inside = runs.filter(F.to_date("created_at").between(day(start), day(end)))
    by_url = urls.select(F.col("project_url").alias("_url")).filter(F.col("_url") != "").distinct().withColumn("_u", F.lit(True))
    any_tag = "\x00"  # no tag is spelled like this
    wanted = tags.select(F.coalesce(F.col("pipeline_tags"), F.lit(any_tag)).alias("pipeline_tags"))
    by_tag = matching_tag_arrays(inside, wanted, "pipeline_tags", any_tag).withColumn("_t", F.lit(True))
    marked = inside.join(by_url, inside["git_url"] == by_url["_url"], "left").join(
        by_tag, F.col("pipeline_tags").eqNullSafe(F.col("_tags")), "left"
    )
    kept = marked.filter(F.coalesce("_u", "_t", F.lit(False)))
    run = ("pipeline_id", "pipeline_name", "step_id", "step_name", "run_count")
    return kept.select(*runs.columns).distinct().groupBy(*run).agg(F.count("*").alias("n"))


def secret_summary(scans: DataFrame, issues: DataFrame) -> DataFrame:
    """Scans, their reported totals and their issue rows, per repository and flow.

    Issues are counted per scan before the join. Summing after it would repeat a scan's total once per issue row.
    """
    per_scan = issues.groupBy("scan_id").agg(F.count("*").alias("_n"))
    return (
        scans.join(per_scan, "scan_id", "left")
        .groupBy("repository", "flow_name")
        .agg(
            F.count_distinct("scan_id").alias("n_scans"),
            F.sum("total_issues").alias("sum_total_issues"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("n_issue_rows"),
        )
    )


def execution_status(executions: DataFrame) -> DataFrame:
    """Executions by status and final flag, with their nested tickets counted."""
    return executions.groupBy("project_name", F.col("status.name").alias("status"), F.col("status.final").alias("final")).agg(
        F.count("*").alias("executions"),
        F.coalesce(F.sum(F.when(F.col("tickets").isNotNull(), F.size("tickets"))), F.lit(0)).alias("tickets"),
    )


def tickets_by_type(executions: DataFrame) -> DataFrame:
    tickets = executions.select("project_name", F.col("status.name").alias("status"), F.explode("tickets").alias("k"))
    return tickets.groupBy("project_name", "status", F.col("k.issue_type").alias("issue_type")).agg(F.count("*").alias("n"))


def volume_outliers(
    alerts: DataFrame, keys: Sequence[str] = ("organization",), rows: int = 7, factor: float = 1.5
) -> DataFrame:
    """Days whose alert count is at least ``factor`` times the mean of the preceding active days.

    Alerts are counted per key and day first; the trailing window runs over days. Compared without a division.
    """
    daily = alerts.groupBy(*keys, F.to_date("created_at").alias("day")).agg(F.count("*").alias("alerts"))
    before = Window.partitionBy(*keys).orderBy("day").rowsBetween(-rows, -1)
    base = daily.withColumns({"_sum": F.sum("alerts").over(before), "_days": F.count("alerts").over(before)})
    hot = base.filter((F.col("_days") == rows) & (F.col("alerts") * F.col("_days") >= F.col("_sum") * F.lit(float(factor))))
    return hot.select(*keys, "day", "alerts", F.round(ratio(F.col("_sum"), F.col("_days")), 2).alias("baseline"))
