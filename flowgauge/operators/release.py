"""Release summaries from arrays of JSON objects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import ratio, seconds_between
from flowgauge.operators.ordering import exact_median
from flowgauge.schemas import RELEASE_JSON


def unpack(releases: DataFrame, column: str, keys: Sequence[str] = ("fix_version",), schema: str | None = None) -> DataFrame:
    """One typed row per JSON object of an array column. A NULL array gives no rows; an unreadable object gives NULLs."""
    texts = releases.select(*keys, F.explode(column).alias("_json"))
    return texts.select(*keys, F.from_json("_json", schema or RELEASE_JSON[column]).alias("_o")).select(*keys, "_o.*")


def unpack_tagged(releases: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("fix_version",)) -> DataFrame:
    """One row per JSON object of several array columns, in one pass: ``kind`` names the column, and the struct of that
    name holds the typed object; the structs of the other columns are NULL.

    The arrays become one array of tagged texts, so a release is read and exploded once, however many columns there are.
    """

    def tagged(name: str) -> Column:
        return F.transform(F.coalesce(F.col(name), F.array().cast("array<string>")), lambda j: F.struct(F.lit(name).alias("kind"), j.alias("json")))

    texts = releases.select(*keys, F.explode(F.concat(*[tagged(c) for c in columns])).alias("_o")).select(*keys, "_o.kind", F.col("_o.json").alias("_json"))
    return texts.select(*keys, "kind", *[F.from_json(F.when(F.col("kind") == c, F.col("_json")), RELEASE_JSON[c]).alias(c) for c in columns])


def percent(part: Column, whole: Column) -> Column:
    return F.round(ratio(part, whole, 100), 2)


def time(c: str) -> Column:
    return F.col(c).try_cast("timestamp_ntz")


def issue_completion(releases: DataFrame, keys: Sequence[str] = ("fix_version",)) -> DataFrame:
    """Done and total issues, and the median cycle time of the done ones.

    Equal cycle times are counted first; the median is found by rank selection over these counts.
    """
    done = F.col("is_done") == "true"
    counted = (
        unpack(releases, "issues", keys)
        .groupBy(*keys, F.when(done, F.col("current_time")).alias("seconds"))
        .agg(F.count("*").alias("n"), F.count_if(done).alias("done"))
    )
    totals = counted.groupBy(*keys).agg(
        F.sum("n").alias("total_issues"), F.sum("done").alias("done_issues"), percent(F.sum("done"), F.sum("n")).alias("done_percent")
    )
    return totals.join(exact_median(counted, keys, "seconds", "n", "median_cycle_seconds"), list(keys), "left")


def defect_ratio(releases: DataFrame, keys: Sequence[str] = ("fix_version",)) -> DataFrame:
    n = F.count_if(F.col("isdefect") == "true")
    return unpack(releases, "defects", keys).groupBy(*keys).agg(
        F.count("*").alias("issues"), n.alias("defects"), percent(n, F.count("*")).alias("defect_percent")
    )


def deployment_health(releases: DataFrame, keys: Sequence[str] = ("fix_version",)) -> DataFrame:
    """Per environment: success rate, mean duration and mean lead time in seconds."""
    spent = seconds_between(time("pipeline_started_at"), time("pipeline_finished_at"))
    good = F.count_if(F.col("pipeline_status") == "success")
    return (
        unpack(releases, "deployments", keys)
        .withColumn("spent", spent)
        .groupBy(*keys, F.col("pipeline_group").alias("environment"))
        .agg(
            F.count("*").alias("runs"),
            percent(good, F.count("*")).alias("success_percent"),
            F.round(ratio(F.sum("spent"), F.count("spent")), 2).alias("mean_duration_seconds"),
            F.round(ratio(F.sum("ltfc_seconds"), F.count("ltfc_seconds")), 2).alias("mean_lead_seconds"),
        )
    )


def review_hours(releases: DataFrame, keys: Sequence[str] = ("fix_version",)) -> DataFrame:
    """Mean hours from creation to the latest review and to the merge."""
    created = time("pr_created_datetime")
    rows = unpack(releases, "pull_requests", keys).withColumns(
        {
            "review": seconds_between(created, time("latest_pr_review_submitted_datetime")),
            "merge": seconds_between(created, time("pr_merged_datetime")),
        }
    )
    return rows.groupBy(*keys).agg(
        F.count("*").alias("pull_requests"),
        F.round(ratio(F.sum("review"), F.count("review") * 3600), 2).alias("review_hours"),
        F.round(ratio(F.sum("merge"), F.count("merge") * 3600), 2).alias("merge_hours"),
    )


def pass_rates(releases: DataFrame, keys: Sequence[str] = ("fix_version",)) -> DataFrame:
    """Build and gate pass rates per tool, from one pass over the releases."""
    builds = F.col("kind") == "builds"
    runs = unpack_tagged(releases, ["builds", "gates"], keys).select(
        *keys,
        F.when(builds, "build").otherwise("gate").alias("kind"),
        F.coalesce("builds.tool_type", "gates.tool_type").alias("tool_type"),
        F.coalesce("builds.build_status", "gates.step_status").alias("status"),
    )
    good = F.count_if(F.col("status") == "success")
    return runs.groupBy(*keys, "kind", "tool_type").agg(F.count("*").alias("runs"), percent(good, F.count("*")).alias("pass_percent"))


def open_risks(releases: DataFrame, as_of: str, keys: Sequence[str] = ("fix_version",)) -> DataFrame:
    """Resolved vulnerabilities, open web findings, and open bugs with their mean age in days, from one pass.

    A vulnerability is resolved when it was last active after it was first seen.
    """
    rows = unpack_tagged(releases, ["vulnerabilities", "web_vulnerabilities", "bugs"], keys)
    resolved = F.col("vulnerabilities.last_activity_date").try_cast("date") > F.col("vulnerabilities.activity_date").try_cast("date")
    web_open = (F.col("web_vulnerabilities.IsPresent") == "true") & (F.col("web_vulnerabilities.IsAddressed") == "false")
    bug_open = F.col("bugs.status") == "OPEN"
    age = F.when(bug_open, F.datediff(F.lit(as_of).cast("date"), F.col("bugs.creation_date").try_cast("date")))
    return rows.groupBy(*keys).agg(
        F.count_if(F.col("kind") == "vulnerabilities").alias("vulnerabilities"),
        F.count_if(resolved).alias("resolved_vulnerabilities"),
        F.count_if(web_open).alias("open_web_findings"),
        F.count_if(bug_open).alias("open_bugs"),
        F.round(ratio(F.sum(age), F.count(age)), 2).alias("mean_bug_age_days"),
    )


def test_totals(releases: DataFrame, keys: Sequence[str] = ("fix_version",)) -> DataFrame:
    """Summed test counts. They are kept as text; text that is not a number counts as missing."""
    def n(c: str) -> Column:
        return F.sum(F.col(c).try_cast("int"))

    names = ("total_tests", "success_tests", "failed_tests", "skipped_tests")
    return unpack(releases, "tests", keys).groupBy(*keys).agg(
        *[n(c).alias(c) for c in names], percent(n("success_tests"), n("total_tests")).alias("pass_percent")
    )


def releases_of_levels(releases: DataFrame, values: Sequence[str], level_name: str = "level_3") -> DataFrame:
    """Releases of the listed level values, newest first."""
    kept = releases.filter((F.col("level_name") == level_name) & F.col("level_value").isin(list(values)))
    return (
        kept.groupBy("level_value", "fix_version", "release_status")
        .agg(F.max("release_date").alias("release_date"), F.count("*").alias("n_rows"))
        .orderBy(F.desc("release_date"), "level_value", "fix_version", "release_status")
    )


def rows_per_level(releases: DataFrame) -> DataFrame:
    return releases.groupBy("level_name", "level_value").agg(F.count("*").alias("n_rows"))
