"""Delivery metrics: deployment frequency, lead time, failure rate, time to restore, cycle time, and their scorecards.

Each metric is first an additive aggregate (counts and sums per level, team and period). Rates and averages are ratios
of those sums, so a parent level is exact when it is summed from its children.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.bands import band
from flowgauge.functions.columns import any_of, git_url_key, period_start, ratio, seconds_between, week_label, year_month
from flowgauge.operators.filters import array_filter_join
from flowgauge.operators.ordering import latest_record, previous_value, refined_bucket, spread_to_next

KEYS = ("level", "team")

ADDITIVE = (
    "success_deployments",
    "failed_deployments",
    "commits_count",
    "total_ltfc",
    "cfr_total_changes",
    "cfr_total_failures",
    "total_incidents",
    "resolved_incidents",
    "total_mttr_seconds",
    "ctfc_count_issues",
    "total_ctfc",
)


def deployment_frequency(deploys: DataFrame, grain: str, keys: Sequence[str] = KEYS, step: str = "deploy") -> DataFrame:
    """Successful and failed deploy steps per period. Runs that are still going count as neither."""
    return (
        deploys.filter((F.col("step_name") == step) & F.col("pipeline_status").isin("success", "failed"))
        .groupBy(*keys, period_start("pipeline_started_at", grain).alias("period"))
        .agg(
            F.count_if(F.col("pipeline_status") == "success").alias("success_deployments"),
            F.count_if(F.col("pipeline_status") == "failed").alias("failed_deployments"),
        )
    )


def lead_time(deploys: DataFrame, commits: DataFrame, grain: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Commit to deploy, in days, over the commits a successful deploy shipped.

    A commit dated after its deploy counts with negative days, and is also counted apart.
    """
    shipped = deploys.filter(F.col("pipeline_commit_sha").isNotNull() & (F.col("pipeline_status") == "success"))
    joined = shipped.join(
        commits.select("to_sha", "committed_date"),
        F.col("pipeline_commit_sha") == F.col("to_sha"),
    )
    days = F.datediff("pipeline_started_at", "committed_date")
    return joined.groupBy(*keys, period_start("pipeline_started_at", grain).alias("period")).agg(
        F.count("*").alias("commits_count"),
        F.count_if(F.col("committed_date") > F.col("pipeline_started_at")).alias("commits_after_deploy"),
        F.sum(days).alias("total_ltfc"),
    )


def change_failures(incidents: DataFrame, grain: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Changes and failed changes per period, among resolved tickets."""
    return (
        incidents.filter(F.col("issue_resolution_date").isNotNull())
        .groupBy(*keys, period_start("issue_created", grain).alias("period"))
        .agg(
            F.count("cfr_total_changes_key").alias("cfr_total_changes"),
            F.count("cfr_total_failures_key").alias("cfr_total_failures"),
        )
    )


def restore_times(incidents: DataFrame, grain: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Incidents, resolved incidents and their seconds from creation to resolution."""
    spent = seconds_between("issue_created", "issue_resolution_date")
    return (
        incidents.filter(F.col("mttr_issue_key").isNotNull())
        .groupBy(*keys, period_start("issue_created", grain).alias("period"))
        .agg(
            F.count("*").alias("total_incidents"),
            F.count("issue_resolution_date").alias("resolved_incidents"),
            F.sum(spent).alias("total_mttr_seconds"),
        )
    )


def cycle_time_issues(history: DataFrame, filt: DataFrame, start: str, end: str, carry: Sequence[str] = ()) -> DataFrame:
    """Newest qualifying status change per issue inside the window, with days since the issue was created.

    With ``carry``, per issue and value of those columns of the filter; see ``array_filter_join``.
    """
    changed = F.col("issue_updated").cast("date")
    status_changes = history.filter(
        F.lower("issue_changelog_itemsfield").isin("status", "epic status")
        & changed.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    ).withColumn("board_ids", F.transform("board_info", lambda b: b["board_id"].cast("string")))
    matched = array_filter_join(status_changes, filt, carry=carry)
    newest = latest_record(matched, [*carry, "issue_key"], [F.desc("issue_updated"), F.desc("change_id")])
    return newest.withColumn("cycle_days", F.datediff("issue_updated", "issue_created"))


def cycle_time(issues: DataFrame, grain: str, keys: Sequence[str] = KEYS) -> DataFrame:
    return issues.groupBy(*keys, period_start("issue_updated", grain).alias("period")).agg(
        F.count("*").alias("ctfc_count_issues"), F.sum("cycle_days").alias("total_ctfc")
    )


# ---- one scope for all metrics ----------------------------------------------------------------------------------------
#
# A scope is resolved once from the filter hierarchy into rules: which repositories, stages and statuses, and which ticket
# projects, stand for which level. Facts are summed by the key that carries the scope first (repository and stage, or
# project), so the rules meet a small relation and a fact that several levels list is not multiplied.


def deploy_rules(flat: DataFrame, level: str = "level_3") -> DataFrame:
    """kpi, level, repo, stage and the statuses that count as success, from flattened filters.

    Stages and statuses are those that the level's configuration lists beside its repositories; without any, nothing counts.
    """
    listed = flat.select(
        "kpi", F.col(level).alias("level"), F.explode("project_url").alias("_url"), "deployment_stages", F.col("pipeline_status_success").alias("_ok")
    )
    stages = listed.select("kpi", "level", git_url_key("_url").alias("repo"), F.explode("deployment_stages").alias("stage"), "_ok")
    return stages.groupBy("kpi", "level", "repo", "stage").agg(F.array_distinct(F.flatten(F.collect_list("_ok"))).alias("success"))


def ticket_rules(flat: DataFrame, kpis: Sequence[str], level: str = "level_3") -> DataFrame:
    """level and project of the tickets, with one flag for each metric id."""
    listed = flat.filter(F.col("kpi").isin(list(kpis))).select("kpi", F.col(level).alias("level"), F.explode("project_name").alias("issue_project"))
    return listed.groupBy("level", "issue_project").agg(*[F.max(F.col("kpi") == k).alias(k) for k in kpis])


SCOPE_KEY = ("repo", "stage", "pipeline_status", "team", "period")


def of_scope(deploys: DataFrame, grain: str) -> DataFrame:
    """Deploys with the columns that the scope is carried by."""
    return deploys.withColumns({"repo": git_url_key("project_url"), "stage": F.col("step_name"), "period": period_start("pipeline_started_at", grain)})


def frequency_in_scope(deploys: DataFrame, rules: DataFrame, kpi: str, grain: str, failed: Sequence[str] = ("failed",)) -> DataFrame:
    """Successful and failed deploys per level, team and period, by the level's own stages and statuses."""
    counts = of_scope(deploys, grain).groupBy(*SCOPE_KEY).agg(F.count("*").alias("n"))
    judged = counts.join(rules.filter(F.col("kpi") == kpi), ["repo", "stage"])
    good = F.array_contains("success", F.col("pipeline_status"))
    bad = F.col("pipeline_status").isin(list(failed)) & ~good
    return judged.filter(good | bad).groupBy(*KEYS, "period").agg(
        F.sum(F.when(good, F.col("n")).otherwise(0)).alias("success_deployments"), F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("failed_deployments")
    )


def lead_time_in_scope(deploys: DataFrame, commits: DataFrame, rules: DataFrame, kpi: str, grain: str) -> DataFrame:
    """Commit to deploy, in days, per level, team and period, over the commits that the level's successful deploys shipped."""
    shipped = of_scope(deploys.filter(F.col("pipeline_commit_sha").isNotNull()), grain)
    joined = shipped.join(commits.select("to_sha", "committed_date"), F.col("pipeline_commit_sha") == F.col("to_sha"))
    counts = joined.groupBy(*SCOPE_KEY).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("committed_date") > F.col("pipeline_started_at")).alias("late"),
        F.sum(F.datediff("pipeline_started_at", "committed_date")).alias("days"),
    )
    judged = counts.join(rules.filter(F.col("kpi") == kpi), ["repo", "stage"]).filter(F.array_contains("success", F.col("pipeline_status")))
    return judged.groupBy(*KEYS, "period").agg(
        F.sum("n").alias("commits_count"), F.sum("late").alias("commits_after_deploy"), F.sum("days").alias("total_ltfc")
    )


def tickets_in_scope(incidents: DataFrame, rules: DataFrame, cfr: str | None, mttr: str | None, grain: str) -> DataFrame:
    """Changes, failed changes, incidents and their time to restore per level, team and period, from one pass.

    ``cfr`` and ``mttr`` are the metric ids whose projects count; a metric without one is left out.
    """
    resolved, incident = F.col("issue_resolution_date").isNotNull(), F.col("mttr_issue_key").isNotNull()
    spent = seconds_between("issue_created", "issue_resolution_date")
    sums = incidents.groupBy("issue_project", "team", period_start("issue_created", grain).alias("period")).agg(
        F.count_if(resolved).alias("_changes"),
        F.count(F.when(resolved, F.col("cfr_total_changes_key"))).alias("cfr_total_changes"),
        F.count(F.when(resolved, F.col("cfr_total_failures_key"))).alias("cfr_total_failures"),
        F.count_if(incident).alias("total_incidents"),
        F.count(F.when(incident, F.col("issue_resolution_date"))).alias("resolved_incidents"),
        F.sum(F.when(incident, spent)).alias("total_mttr_seconds"),
    )
    judged = sums.join(rules, "issue_project")
    wanted = {cfr: ("_changes", "cfr_total_changes", "cfr_total_failures"), mttr: ("total_incidents", "resolved_incidents", "total_mttr_seconds")}
    wanted.pop(None, None)
    present = any_of([F.col(kpi) & (F.col(columns[0]) > 0) for kpi, columns in wanted.items()])
    measures = [F.sum(F.when(F.col(kpi), F.col(c))).alias(c) for kpi, columns in wanted.items() for c in columns if c != "_changes"]
    return judged.filter(present).groupBy(*KEYS, "period").agg(*measures)


def combine(parts: Sequence[DataFrame], keys: Sequence[str] = KEYS) -> DataFrame:
    """The metrics side by side: one row per key and period that any of them has. Missing measures are 0.

    A union and one small aggregate do the work of a chain of full outer joins.
    """
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p, allowMissingColumns=True)
    measures = [c for c in both.columns if c not in (*keys, "period")]
    return both.groupBy(*keys, "period").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in measures]
    )


def with_sublevels(per_team: DataFrame, level: str = "level", team: str = "team") -> DataFrame:
    """Per period: a total row per level (``sub_level`` NULL) and one row per team.

    ``is_total`` tells a total from a team whose name is NULL. The input is already aggregated per team, so the grouping
    sets expand a small relation and never the fact.
    """
    measures = [c for c in per_team.columns if c not in (level, team, "period")]
    sets = [["period", level], ["period", level, team]]
    columns = [F.col(c) for c in ("period", level, team)]
    out = per_team.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping(team).alias("_total"), *[F.sum(m).cast("bigint").alias(m) for m in measures]
    )
    return out.withColumn("is_total", F.col("_total") == 1).drop("_total").withColumnRenamed(team, "sub_level")


def score(sums: DataFrame) -> DataFrame:
    """Rates, averages and bands for the measures at hand. The failure rate is 0 when there were no changes."""
    have, out = set(sums.columns), {}
    if "success_deployments" in have:
        out["total_deployments"] = F.col("success_deployments") + F.col("failed_deployments")
        out["df_flag"] = band("df", out["total_deployments"])
    if "commits_count" in have:
        out["average_ltfc"] = F.round(ratio(F.col("total_ltfc"), F.col("commits_count")), 2)
        out["ltfc_flag"] = band("ltfc", out["average_ltfc"])
    if "cfr_total_changes" in have:
        percent = ratio(F.col("cfr_total_failures"), F.col("cfr_total_changes"), 100)
        out["cfr_value"] = F.round(F.coalesce(percent, F.lit(0.0)), 2)
        out["cfr_flag"] = band("cfr", out["cfr_value"])
    if "total_incidents" in have:
        out["avg_mttr"] = F.round(ratio(F.col("total_mttr_seconds"), F.col("resolved_incidents") * 3600), 2)
        out["mttr_flag"] = band("mttr", out["avg_mttr"])
    if "ctfc_count_issues" in have:
        out["ctfc_value"] = F.round(ratio(F.col("total_ctfc"), F.col("ctfc_count_issues")), 2)
        out["ctfc_flag"] = band("ctfc", out["ctfc_value"])
    return sums.withColumns(out)


def monthly_scorecard(sums: DataFrame) -> DataFrame:
    return score(sums).withColumns(
        {"year_month": year_month("period"), "month_name": F.date_format("period", "MMM yyyy")}
    )


def weekly_scorecard(sums: DataFrame) -> DataFrame:
    """Weeks start on Monday; label and month come from that Monday."""
    return score(sums).withColumns({"year_month": year_month("period"), "week_name": week_label("period")})


def daily_snapshot(
    sums: DataFrame, start: str, end: str, keys: Sequence[str] = ("level", "sub_level", "is_total")
) -> DataFrame:
    """One row per key and day of the whole range, for the keys with any activity in it; idle days are filled with 0."""
    measures = [c for c in sums.columns if c not in (*keys, "period")]
    spread = spread_to_next(sums, keys, "period", F.lit(start).cast("date"), F.lit(end).cast("date"), "date")
    active = F.col("date") == F.col("period")
    return spread.select(*keys, "date", *[F.when(active, F.col(m)).otherwise(0).alias(m) for m in measures])


METRIC_COLUMNS: Mapping[str, Sequence[str]] = {
    "df": ("success_deployments", "failed_deployments", "total_deployments", "df_flag"),
    "ltfc": ("commits_count", "total_ltfc", "average_ltfc", "ltfc_flag"),
    "cfr": ("cfr_total_changes", "cfr_total_failures", "cfr_value", "cfr_flag"),
    "mttr": ("total_incidents", "resolved_incidents", "avg_mttr", "mttr_flag"),
    "ctfc": ("ctfc_count_issues", "ctfc_value", "ctfc_flag"),
}


def metric_table(scorecard: DataFrame, metric: str, label: str) -> DataFrame:
    """One metric of a scorecard, as its own narrow table. The scorecard may be built from that metric's sums alone."""
    return scorecard.select("level", "sub_level", "year_month", label, *METRIC_COLUMNS[metric])


def phase(day: str | Column, cut: str) -> Column:
    """``before`` or ``after`` an inflection date; the date itself is ``after``."""
    day = F.col(day) if isinstance(day, str) else day
    return F.when(day.cast("date") < F.lit(cut).cast("date"), "before").otherwise("after")


def compare_phases(df: DataFrame, day: str, cut: str, measures: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """The same measures in the two phases around an inflection date."""
    return df.groupBy(*keys, phase(day, cut).alias("phase")).agg(*measures)


def deploy_chain(deploys: DataFrame, keys: Sequence[str] = ("project_name",), most: int = 100_000) -> DataFrame:
    """Successful deploys with ``from_sha``: the sha of the previous successful deploy of the same project.

    Deploys are ordered inside a project's day; a day with over ``most`` of them is cut further, see ``refined_bucket``.
    """
    done = deploys.filter((F.col("pipeline_status") == "success") & F.col("pipeline_commit_sha").isNotNull())
    timed = done.withColumn("_second", F.unix_seconds(F.col("pipeline_started_at").cast("timestamp")))
    ordered = refined_bucket(timed, keys, F.to_date("pipeline_started_at"), ["_second", "run_id"], "_slot", most)
    chained = previous_value(ordered, keys, ("pipeline_started_at", "run_id"), "pipeline_commit_sha", "from_sha", F.col("_slot"))
    return chained.drop("_slot", "_second")


def activity_counts(deploys: DataFrame, by: Sequence[str], limit: int | None = None) -> DataFrame:
    """Rows per combination, most frequent first; ties in key order."""
    out = deploys.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)
    return out if limit is None else out.limit(limit)


def release_age(releases: DataFrame, as_of: str, windows: Sequence[int] = (30, 90, 365)) -> DataFrame:
    """Days since the release on an explicit date, and the smallest last-N-days window it falls in."""
    out = releases.withColumn("age_days", F.datediff(F.lit(as_of).cast("date"), F.col("release_date")))
    bucket = F.lit("older")
    for n in sorted(windows, reverse=True):
        bucket = F.when(F.col("age_days") <= n, F.lit(f"last {n} days")).otherwise(bucket)
    return out.withColumn("age_window", F.when(F.col("age_days") < 0, F.lit("upcoming")).otherwise(bucket))
