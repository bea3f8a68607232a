"""Value stream: one sparse fact of commits, pull requests and delivery steps around an issue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import flag
from flowgauge.operators.filters import STAGES, stage_is


def stacked(commits: DataFrame, prs: DataFrame, steps: DataFrame) -> DataFrame:
    """Commits, pull requests and steps in one relation. A row is of one kind: only that kind's id is set."""
    return commits.unionByName(prs, allowMissingColumns=True).unionByName(steps, allowMissingColumns=True)


def build_flow_fact(commits: DataFrame, prs: DataFrame, steps: DataFrame, issues: DataFrame) -> DataFrame:
    """Sparse wide fact: one row per commit, pull request or step, with the issue's context on every row.

    The three kinds are stacked first, so the issue context is joined once.
    """
    context = issues.select(
        F.col("issue_key").alias("ticket_key"),
        F.col("sprint_name").alias("jira_sprint"),
        F.col("issue_type").alias("jira_issue_type"),
        F.col("issue_status").alias("jira_status"),
        F.col("issue_project").alias("project_name"),
    )
    return stacked(commits, prs, steps).join(context, "ticket_key", "left")


# Where each kind of event keeps what a timeline shows. Columns that a kind does not have stay NULL.
TIMELINE: Mapping[str, Mapping[str, str]] = {
    "commit": {
        "id": "commit_id", "at": "commit_timestamp", "author": "commit_author", "title": "commit_title", "lines_added": "commit_lines_added",
        "lines_removed": "commit_lines_removed", "lines_modified": "commit_lines_modified",
    },
    "pr": {"id": "pr_id", "at": "pr_created_datetime", "author": "pr_user_name", "title": "pr_title", "step_type": "pr_state"},
    "step": {"id": "pipeline_id", "at": "pipeline_started_at", "title": "pipeline_step_name", "step_conclusion": "pipeline_step_conclusion", "step_type": "pipeline_step_type"},
}


def issue_stream(commits: DataFrame, prs: DataFrame, steps: DataFrame, issues: DataFrame, key: str) -> DataFrame:
    """Timeline of one issue: commits, pull requests and named steps in one shape, newest first.

    Every source is cut to the issue before anything is stacked or joined, so the filter reaches each scan; a step is
    listed under its own type.
    """
    out = None
    for (kind, places), source in zip(TIMELINE.items(), (commits, prs, steps), strict=True):
        mine = source.filter((F.col("ticket_key") == key) & F.col(places["id"]).isNotNull() & (F.lit(kind != "step") | F.col(places["title"]).isNotNull()))
        label = F.col("pipeline_step_type") if kind == "step" else F.lit(kind)
        assisted = {"ai_assisted": flag("copilot_commit_flag")} if kind == "commit" else {}
        columns = {"data_type": label} | {name: F.col(c) for name, c in places.items()} | assisted | {"org_name": F.col("org_name")}
        shaped = mine.select(*[c.alias(name) for name, c in columns.items()])
        out = shaped if out is None else out.unionByName(shaped, allowMissingColumns=True)
    project = issues.filter(F.col("issue_key") == key).select(F.max("issue_project")).scalar()
    return out.withColumn("project_name", project).orderBy(F.desc("at"), "data_type", "id")


def top_issues(events: DataFrame, issues: DataFrame, k: int | None = None) -> DataFrame:
    """Issues by number of flow rows, with distinct commits and pull requests; ties in key order.

    Rows are counted per entity first, so the second aggregate only adds and nothing is expanded for the distinct
    counts. The sprint is looked up for the issues that are left, not for every event.
    """
    per_entity = (
        events.filter(F.col("ticket_key") != "")
        .groupBy(F.col("ticket_key").alias("issue_key"), "commit_id", "pr_id", "pipeline_id")
        .agg(F.count("*").alias("n"))
    )
    counted = (
        per_entity.groupBy("issue_key")
        .agg(F.sum("n").alias("flow_refs"), F.count("commit_id").alias("commit_count"), F.count("pr_id").alias("pr_count"))
        .orderBy(F.desc("flow_refs"), "issue_key")
    )
    top = counted if k is None else counted.limit(k)
    sprints = issues.select("issue_key", "sprint_name")
    out = top.join(sprints, "issue_key", "left").groupBy("issue_key", "flow_refs", "commit_count", "pr_count").agg(F.max("sprint_name").alias("sprint"))
    return out.select("issue_key", "sprint", "flow_refs", "commit_count", "pr_count").orderBy(F.desc("flow_refs"), "issue_key")


def entity_counts(events: DataFrame, key: str) -> DataFrame:
    return events.filter(F.col("ticket_key") == key).agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("commit_id").alias("distinct_commits"),
        F.count_distinct("pr_id").alias("distinct_prs"),
        F.count_distinct("pipeline_id").alias("distinct_runs"),
    )


def sprint_label(at: Column, start: str, length: int, prefix: str = "Sprint") -> Column:
    """Sprint of a day by its offset from the start, without an end; days before the start are labelled so."""
    number = F.floor(F.datediff(at, F.lit(start).cast("date")) / F.lit(length)) + 1
    return F.when(number < 1, f"Before {prefix} 1").otherwise(F.concat(F.lit(f"{prefix} "), number.cast("string")))


def validate(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """Violations: one row per row and broken rule. A rule that is NULL for a row is not broken. One pass for all rules."""
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    return df.select(*keys, F.explode(broken).alias("rule"))


def usage_rules() -> dict[str, Column]:
    """Accepted may not exceed generated, nor lines added or deleted those suggested."""
    pairs = (
        ("accepted_within_generated", "code_acceptance_activity_count", "code_generation_activity_count"),
        ("added_within_suggested", "loc_added_sum", "loc_suggested_to_add_sum"),
        ("deleted_within_suggested", "loc_deleted_sum", "loc_suggested_to_delete_sum"),
    )
    return {name: F.col(part) <= F.col(whole) for name, part, whole in pairs}


def failed_steps(
    runs: DataFrame, details: DataFrame, logs: DataFrame, events: DataFrame, as_of: str, days: int = 30
) -> DataFrame:
    """Failed steps of the last days with their ticket, the length of their log and the ticket's number of flow rows.

    Runs meet their details on run and project, and logs on the step id as text. A log is reduced to its length before
    it moves, and flow rows are counted for the failed tickets only.
    """
    failed = runs.filter((F.col("step_conclusion") == "failure") & F.col("step_id").isNotNull()).select(
        "pipeline_id", "project_name", "step_id", "step_name"
    )
    recent = details.filter(
        F.to_date("pipeline_started_at").between(F.date_sub(F.lit(as_of).cast("date"), days), F.lit(as_of).cast("date"))
    ).select("pipeline_id", "project_name", "ticket_key", "pipeline_started_at")
    hits = failed.join(recent, ["pipeline_id", "project_name"])
    refs = events.join(hits.select("ticket_key"), "ticket_key", "left_semi").groupBy("ticket_key").agg(F.count("*").alias("flow_rows"))
    lengths = logs.select(F.col("job").alias("step_id"), F.length("logs").cast("bigint").alias("log_length"))
    return (
        hits.join(lengths, "step_id")
        .join(refs, "ticket_key", "left")
        .withColumn("flow_rows", F.coalesce("flow_rows", F.lit(0)))
    )


def distinct_failures(runs: DataFrame, keys: Sequence[str] = ("project_name",)) -> DataFrame:
    """Failures counted once per step and project, however often a step is listed."""
    return (
        runs.filter(F.col("step_conclusion") == "failure")
        .groupBy(*keys)
        .agg(F.count("*").alias("rows"), F.count_distinct("step_id", "project_name").alias("failures"))
    )


def recent_failures(runs: DataFrame, tag: str, as_of: str, days: int = 30) -> DataFrame:
    """Failures per tag and project in the last days, most first."""
    since = F.date_sub(F.lit(as_of).cast("date"), days)
    return (
        runs.filter((F.col("step_conclusion") == "failure") & F.to_date("pipeline_started_at").between(since, F.lit(as_of).cast("date")))
        .groupBy(tag, "project_name")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), tag, "project_name")
    )


def stage_badges(fact: DataFrame) -> DataFrame:
    """Per issue of the fact: which delivery stages it has reached. An issue without steps has reached none.

    A step counts by its type or its name, so one without a name counts by its type.
    """
    return fact.groupBy("ticket_key").agg(*[F.bool_or(stage_is(s)).alias(f"has_{s}") for s in STAGES])


def ai_assisted_commits(fact: DataFrame, keys: Sequence[str] = ("org_name",)) -> DataFrame:
    """Distinct commits and AI-assisted ones. Every spelling of the flag counts; comparing 'Y' with TRUE gave 0."""
    per_commit = fact.groupBy(*keys, "commit_id").agg(F.bool_or(flag("copilot_commit_flag")).alias("assisted"))
    return per_commit.groupBy(*keys).agg(
        F.count("commit_id").alias("commits"),
        F.count_if(F.col("assisted") & F.col("commit_id").isNotNull()).alias("ai_assisted_commits"),
    )
