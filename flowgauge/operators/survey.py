"""Developer surveys: period tags, dimension scores, coverage, and scores against commit velocity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.bands import answer_score
from flowgauge.functions.columns import lookup, ratio
from flowgauge.operators.activity import parent_count, project_commit_metrics
from flowgauge.operators.filters import level_any_join
from flowgauge.operators.ordering import latest_record

CURRENT, PREVIOUS = "current_period", "previous_period"
DIMENSIONS = ("s", "p", "a", "c", "e")


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def window_before(start: str, end: str) -> tuple[str, str]:
    """The window of the same length that ends the day before."""
    a, b = date.fromisoformat(start), date.fromisoformat(end)
    length = (b - a).days + 1
    return (a - timedelta(days=length)).isoformat(), (a - timedelta(days=1)).isoformat()


def tag_period(df: DataFrame, at: str, start: str, end: str, alias: str = "period") -> DataFrame:
    """Rows of the window and of the equal window before it, tagged. Other rows are filtered out, before any join."""
    before, before_end = window_before(start, end)
    d = F.col(at).cast("date")
    return df.filter(d.between(day(before), day(end))).withColumn(
        alias, F.when(d >= day(start), CURRENT).when(d <= day(before_end), PREVIOUS)
    )


def scored(responses: DataFrame, dims: Mapping[str, str], start: str, end: str) -> DataFrame:
    """Answers to the dimension questions in both windows, with their score and dimension."""
    asked = responses.filter(F.col("question_id").isin(list(dims)))
    return tag_period(asked, "last_submitted_timestamp", start, end).select(
        "survey_id", "response_id", "period", lookup("question_id", dims).alias("dimension"), answer_score("answer").alias("score")
    )


def fixed(c: Column) -> Column:
    """Fixed-point copy, so that a mean of means does not depend on the order of addition."""
    return c.cast("decimal(20,8)")


def space_overview(responses: DataFrame, dims: Mapping[str, str], start: str, end: str) -> DataFrame:
    """Mean per response and dimension, then the mean over responses (a missing dimension counts 0). One row per period."""
    per_response = (
        scored(responses, dims, start, end)
        .groupBy("survey_id", "response_id", "period")
        .agg(*[F.coalesce(fixed(F.avg(F.when(F.col("dimension") == d, F.col("score")))), F.lit(0)).alias(d) for d in DIMENSIONS])
    )
    total = sum((F.col(d) for d in DIMENSIONS[1:]), F.col(DIMENSIONS[0]))
    n = F.count("*")
    return per_response.groupBy("period").agg(
        *[F.round(ratio(F.sum(d), n), 2).alias(f"avg_{d}_score") for d in DIMENSIONS],
        F.round(ratio(F.sum(total), n * len(DIMENSIONS)), 2).alias("overall_space_score"),
        F.count_distinct("response_id").alias("active_respondents"),
    )


def space_dimensions(responses: DataFrame, dims: Mapping[str, str], start: str, end: str) -> DataFrame:
    """One row per period, one score column per dimension.

    Two defects of the dashboard query are corrected on purpose: its filter admitted the current period only, so the
    previous period never had a row; and it divided by questions times distinct respondents, which inflates the score when
    a window holds several surveys. Here both periods pass and the divisor is the number of answers.
    """
    per_dim = (
        scored(responses, dims, start, end)
        .groupBy("period", "dimension")
        .agg(F.round(ratio(F.sum("score"), F.count("*")), 2).alias("score"))
    )
    return per_dim.groupBy("period").agg(
        *[F.max(F.when(F.col("dimension") == d, F.col("score"))).alias(f"{d}_score") for d in DIMENSIONS]
    )


def survey_coverage(responses: DataFrame, start: str, end: str) -> DataFrame:
    """Rows, distinct surveys, responses and questions, first and last date per period."""
    at = F.to_date("last_submitted_timestamp")
    return (
        tag_period(responses, "last_submitted_timestamp", start, end)
        .groupBy("period")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_distinct("survey_id").alias("n_surveys"),
            F.count_distinct("response_id").alias("n_responses"),
            F.count_distinct("question_id").alias("n_questions"),
            F.min(at).alias("min_date"),
            F.max(at).alias("max_date"),
        )
    )


def response_rate(responses: DataFrame, roster: int, keys: Sequence[str] = ("survey_id",)) -> DataFrame:
    """Distinct responders in percent of a roster of known size."""
    n = F.count_distinct("response_id")
    return responses.groupBy(*keys).agg(
        n.alias("responders"), F.round(ratio(n, F.lit(roster), 100), 2).alias("response_rate_percent")
    )


def activity_by_period(commits: DataFrame, prs: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct commits and pull requests, one row per period, also when a period has none."""
    c = tag_period(commits, "commit_date", start, end).groupBy("period").agg(F.count_distinct("commit_id").alias("n_commits"))
    p = tag_period(prs, "pr_created_datetime", start, end).groupBy("period").agg(F.count("*").alias("n_prs"))
    both = commits.sparkSession.createDataFrame([(CURRENT,), (PREVIOUS,)], "period string")
    rows = both.unionByName(c, allowMissingColumns=True).unionByName(p, allowMissingColumns=True)
    return rows.groupBy("period").agg(*[F.coalesce(F.max(m), F.lit(0)).alias(m) for m in ("n_commits", "n_prs")])


def survey_projects(responses: DataFrame, mapping: DataFrame, level: str, window: tuple[str, str]) -> DataFrame:
    """Distinct (survey, score, project): mean 1-to-5 score per survey and level value, joined to the projects of any level.

    ``mapping`` has level_1 to level_4 and project_url; ``responses`` carries the level arrays in ``filters``.
    """
    n = F.col("answer").try_cast("int")
    score = F.when(n.between(1, 5), (n - 1) * 25).otherwise(0)
    scores = (
        responses.filter(F.to_date("last_submitted_timestamp").between(day(window[0]), day(window[1])))
        .select("survey_id", F.explode(f"filters.{level}").alias("level_filter"), score.alias("score"))
        .groupBy("survey_id", "level_filter")
        .agg(ratio(F.sum("score"), F.count("*")).alias("overall_space_score"))
    )
    return level_any_join(scores, mapping, "level_filter").select("survey_id", "overall_space_score", "project_url").distinct()


def plain_commits(commits: DataFrame, mapping: DataFrame, window: tuple[str, str]) -> DataFrame:
    """Commit metrics of the mapped projects, without merge commits."""
    listed = commits.join(mapping.select("project_url").distinct(), "project_url", "left_semi")
    return project_commit_metrics(listed.filter(parent_count() == 1), *window)


def score_vs_projects(responses, commits, mapping, level, survey_window, commit_window) -> DataFrame:
    """Every survey and project pair with the project's commit metrics."""
    pairs = survey_projects(responses, mapping, level, survey_window)
    return pairs.join(plain_commits(commits, mapping, commit_window), "project_url")


def score_vs_velocity(responses, commits, mapping, level, survey_window, commit_window) -> DataFrame:
    """Score against commit velocity: each project counts for its best survey only.

    Velocity is commits per active day, weighted by the score; the mean over the projects of a survey is reported.
    """
    pairs = survey_projects(responses, mapping, level, survey_window)
    best = latest_record(pairs, ["project_url"], [F.desc("overall_space_score"), F.desc("survey_id")])
    rows = best.join(plain_commits(commits, mapping, commit_window), "project_url").filter("total_commits > 0")
    velocity = F.round(
        (F.col("total_commits") / F.greatest("active_days", F.lit(1))) * (F.col("overall_space_score") / 100.0), 2
    )
    return rows.groupBy("survey_id", "overall_space_score").agg(
        F.round(F.col("overall_space_score"), 2).alias("space_score_percentage"),
        F.round(ratio(F.sum(velocity.cast("decimal(18,2)")), F.count("*")), 2).alias("commits_per_day"),
        F.sum(F.col("base_commits_per_day").cast("decimal(18,1)")).cast("double").alias("base_commits_per_day"),
    )
