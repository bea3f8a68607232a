"""Commits, pull requests, teams, issues and change requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import flag, period_start, ratio, seconds_between
from flowgauge.operators.ordering import latest_per_key


def parent_count(before_sha: str | Column = "before_sha") -> Column:
    return F.size(F.split(before_sha, ","))


def commit_stats(commits: DataFrame, scope: DataFrame, merges: bool, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct commits in scope, counted over (commit id, web URL); merge commits have more than one parent."""
    parents = parent_count()
    kept = commits.filter(parents >= 1 if merges else parents == 1)
    kept = kept.join(scope.select("project_url").distinct(), "project_url", "left_semi")
    return kept.groupBy(*keys).agg(F.count_distinct("commit_id", "web_url").alias("commit_count"))


def parent_distribution(commits: DataFrame) -> DataFrame:
    return commits.groupBy(parent_count().alias("parents")).agg(F.count("*").alias("n"))


def linked_commits(commits: DataFrame, prs: DataFrame) -> DataFrame:
    """Commit rows that are the first commit of a pull request, per organisation of the commit.

    A pull request may be listed more than once and a commit may have several rows; every pair counts. Both sides are
    counted per sha first, so a sha with many rows on both sides costs one row in the join.
    """
    left = commits.groupBy("org_name", F.col("commit_id").alias("sha")).agg(F.count("*").alias("c"))
    right = prs.groupBy(F.col("first_commit_id").alias("sha")).agg(F.count("*").alias("p"))
    return left.join(right, "sha").groupBy("org_name").agg(F.sum(F.col("c") * F.col("p")).alias("linked"))


def pr_class(commits: str = "pr_commits") -> Column:
    """Copilot, Non-Copilot or Mixed, from the flags of the nested commits. No commits counts as Non-Copilot."""
    by_ai = F.coalesce(F.exists(commits, lambda c: flag(c["copilot_commit_flag"])), F.lit(False))
    by_hand = F.coalesce(F.exists(commits, lambda c: ~flag(c["copilot_commit_flag"])), F.lit(False))
    return F.when(by_ai & by_hand, "Mixed").when(by_ai, "Copilot").otherwise("Non-Copilot")


def pr_stages(prs: DataFrame) -> DataFrame:
    """Seconds of each stage: first commit to creation, creation to first review, creation to merge.

    A stage that has not ended is NULL, and so is coding time without a readable commit time.
    """
    first = F.array_min(F.transform("pr_commits", lambda c: c["commit_timestamp"].try_cast("timestamp_ntz")))
    return prs.withColumns(
        {
            "coding_seconds": seconds_between(first, "pr_created_datetime"),
            "pickup_seconds": seconds_between("pr_created_datetime", "first_pr_review_submitted_datetime"),
            "merge_seconds": seconds_between("pr_created_datetime", "pr_merged_datetime"),
        }
    )


def mean_hours(seconds: str) -> Column:
    """Mean of a seconds column in hours, over the rows that have it."""
    return F.round(ratio(F.sum(seconds), F.count(seconds) * 3600), 2)


def direct_commits(commits: DataFrame, prs: DataFrame) -> DataFrame:
    """Commits that are not inside any pull request."""
    inside = prs.select(F.explode("pr_commits").alias("c")).select(F.col("c.sha").alias("commit_id")).distinct()
    return commits.join(inside, "commit_id", "left_anti")


def flagged_share(commits: DataFrame, grain: str) -> DataFrame:
    """AI-flagged share of the commits per period, in percent."""
    flagged = F.count_if(flag("copilot_commit_flag"))
    return commits.groupBy(period_start("commit_timestamp", grain).alias("period")).agg(
        F.count("*").alias("commits"),
        flagged.alias("flagged"),
        F.round(ratio(flagged, F.count("*"), 100), 2).alias("flagged_percent"),
    )


def language_written(commits: DataFrame, extensions: DataFrame) -> DataFrame:
    """Lines added and deleted per language. Files with an unknown extension are left out.

    Lines are summed per extension before the dictionary is joined.
    """
    files = commits.select(F.explode("file_extension").alias("f"))
    per_ext = files.groupBy(F.col("f.file_extension").alias("code_file_extension")).agg(
        F.sum("f.lines.additions").alias("a"), F.sum("f.lines.deletions").alias("d")
    )
    return (
        per_ext.join(extensions, "code_file_extension")
        .groupBy("code_language")
        .agg(F.sum("a").alias("lines_added"), F.sum("d").alias("lines_deleted"))
    )


def project_commit_metrics(commits: DataFrame, start: str, end: str) -> DataFrame:
    """Per project: distinct commits, active days, and commit rows per day of the window (1 digit)."""
    inside = commits.filter(F.col("commit_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    days = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1
    return inside.groupBy("project_url").agg(
        F.count_distinct("commit_id").alias("total_commits"),
        F.count_distinct("commit_date").alias("active_days"),
        F.round(ratio(F.count("commit_id"), F.max(days)), 1).alias("base_commits_per_day"),
    )


def current_members(teams: DataFrame) -> DataFrame:
    """Membership rows of the newest snapshot of each organisation.

    A newest snapshot taken over all organisations would drop every organisation that was loaded earlier.
    """
    return latest_per_key(teams, ["org_name"], "record_update_date")


def sprint_completion(issues: DataFrame, done: Sequence[str] = ("done", "completed")) -> DataFrame:
    """Done and total issues per sprint, newest sprint first."""
    is_done = F.lower("issue_status").isin(list(done))
    return (
        issues.groupBy("sprint_id", "sprint_name", "sprint_state")
        .agg(
            F.count("*").alias("total"),
            F.count_if(is_done).alias("done"),
            F.round(ratio(F.count_if(is_done), F.count("*"), 100), 1).alias("done_percent"),
            F.sum(F.col("story_points").try_cast("int")).alias("story_points"),
        )
        .orderBy(F.desc("sprint_id"))
    )


def issue_boards(issues: DataFrame, boards: DataFrame) -> DataFrame:
    """One row per issue and known board."""
    return issues.withColumn("board_id", F.explode(F.col("board_info.board_id"))).join(boards, "board_id")


def done_with_resolution(issues: DataFrame, statuses: Sequence[str] = ("done", "completed")) -> DataFrame:
    return issues.filter(F.lower("issue_status").isin(list(statuses)) & F.col("issue_resolution_date").isNotNull())


def change_requests(crs: DataFrame, marker: str = "automated", keys: Sequence[str] = ("scope",)) -> DataFrame:
    """Outcomes per origin. A request is automated when its correlation id carries the marker."""
    automated = F.coalesce(F.contains("correlation_id", F.lit(marker)), F.lit(False))
    days = F.datediff("issue_resolved_at", "issue_started_at")
    total = F.count("*")
    shares = {s: F.count_if(F.col("issue_status") == s) for s in ("Done", "Failed", "Open")}
    return crs.groupBy(*keys, automated.alias("automated")).agg(
        total.alias("total"),
        *[n.alias(s.lower()) for s, n in shares.items()],
        F.round(ratio(shares["Done"], total, 100), 2).alias("done_percent"),
        F.round(ratio(F.sum(days), F.count(days)), 2).alias("mean_resolve_days"),
    )
