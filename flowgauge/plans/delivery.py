"""Queries over the delivery metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgauge.functions.bands import band
from flowgauge.functions.columns import ratio, year_month
from flowgauge.operators import delivery as dl
from flowgauge.operators import filters as fl
from flowgauge.plans.registry import query, rnd, secs
from flowgauge.plans.scope import CTFC_MATCH, CTFC_ROW, ctfc_filters, flat

WINDOW = ("1996-01-01", "2000-12-31")


# The limits of the maturity bands.
def band_sql(metric, v):
    steps = {
        "df": [(30, "elite"), (10, "high"), (3, "medium")],
        "ltfc": [(1, "elite"), (7, "high"), (30, "medium")],
        "cfr": [(15, "elite"), (30, "high"), (45, "medium")],
        "mttr": [(1, "elite"), (24, "high"), (168, "medium")],
    }[metric]
    op = ">=" if metric == "df" else "<="
    return f"CASE WHEN {v} IS NULL THEN NULL " + " ".join(f"WHEN {v} {op} {b} THEN '{n}'" for b, n in steps) + " ELSE 'low' END"


YM = "CAST(year({0}) * 100 + month({0}) AS INTEGER)"
MONTH_NAME = "strftime({0}, '%b %Y')"
WEEK_NAME = "concat(strftime({0}, '%b'), ' W', CAST((day({0}) + 6) // 7 AS VARCHAR), ' ', strftime({0}, '%Y'))"


def trunc(grain, c):
    return f"CAST(date_trunc('{grain}', {c}) AS DATE)"


# ---- single metrics ------------------------------------------------------------------------------------------------


def scope(t, **levels):
    """The flattened filters that delivery metrics are scoped by, of the whole hierarchy or a part of it."""
    rows_ = flat(t, "project_url", "project_name", "deployment_stages", "pipeline_status_success", "issue_status", "include_issue_types", "board_ids")
    return rows_.filter(fl.in_scope(None, **levels))


TICKETS = ("kpi-cfr", "kpi-mttr")


def monthly_frequency(t):
    """Flagship: monthly deployment frequency with its maturity band, for one region of the filter hierarchy."""
    sums = dl.frequency_in_scope(t.deploys, dl.deploy_rules(scope(t, level_1="ASIA")), "kpi-df", "month")
    sums = sums.groupBy("level", "period").agg(*[F.sum(c).alias(c) for c in ("success_deployments", "failed_deployments")])
    total = F.col("success_deployments") + F.col("failed_deployments")
    return sums.select(
        "level",
        year_month("period").alias("year_month"),
        F.date_format("period", "MMM yyyy").alias("month_name"),
        "success_deployments",
        "failed_deployments",
        total.alias("total_deployments"),
        band("df", total).alias("df_flag"),
    )


REPO = r"regexp_replace(d.project_url, '\.git$', '')"


def scoped_deploys_sql(kpi, where="true"):
    """Deploys with the level that lists their repository and stage, and whether the level calls their status a success."""
    return f"""(SELECT r.level, d.team, d.pipeline_started_at, d.pipeline_commit_sha, d.pipeline_status, list_contains(r.ok, d.pipeline_status) AS good
      FROM deploys d JOIN (SELECT level, repo, stage, list(status) AS ok FROM deploy_rules WHERE kpi = '{kpi}' AND level IN (SELECT level_3 FROM flat WHERE {where}) GROUP BY ALL) r
      ON {REPO} = r.repo AND d.step_name = r.stage)"""


query("deployment_frequency_monthly", "D1 D6", "flat deploy_rules deploys", f"""
SELECT level, {YM.format('p')} AS year_month, {MONTH_NAME.format('p')} AS month_name, success_deployments, failed_deployments,
  success_deployments + failed_deployments AS total_deployments, {band_sql('df', '(success_deployments + failed_deployments)')} AS df_flag
FROM (SELECT level, date_trunc('month', pipeline_started_at) AS p, count(*) FILTER (good) AS success_deployments,
    count(*) FILTER (NOT good) AS failed_deployments FROM {scoped_deploys_sql('kpi-df', "level_1 = 'ASIA'")}
  WHERE good OR pipeline_status = 'failed' GROUP BY level, p)""")(monthly_frequency)


def per_level(sums):
    measures = [c for c in sums.columns if c not in ("level", "team", "period")]
    return sums.groupBy("level", "period").agg(*[F.sum(c).alias(c) for c in measures])


@query("lead_time_monthly", "D2 D6", "flat deploy_rules deploys deploy_commits", f"""
SELECT level, {YM.format('p')} AS year_month, n AS commits_count, late AS commits_after_deploy, total AS total_ltfc, {rnd('total * 1.0 / n')} AS average_ltfc,
  {band_sql('ltfc', rnd('total * 1.0 / n'))} AS ltfc_flag
FROM (SELECT level, date_trunc('month', pipeline_started_at) AS p, count(*) AS n, count(*) FILTER (committed_date > pipeline_started_at) AS late,
    CAST(sum(date_diff('day', committed_date, pipeline_started_at)) AS BIGINT) AS total
  FROM {scoped_deploys_sql('kpi-ltfc')} JOIN deploy_commits ON pipeline_commit_sha = to_sha WHERE good GROUP BY level, p)""")
def _(t):
    sums = per_level(dl.lead_time_in_scope(t.deploys, t.deploy_commits, dl.deploy_rules(scope(t)), "kpi-ltfc", "month"))
    average = F.round(ratio(F.col("total_ltfc"), F.col("commits_count")), 2)
    return sums.select(
        "level", year_month("period").alias("year_month"), "commits_count", "commits_after_deploy", "total_ltfc", average.alias("average_ltfc"),
        band("ltfc", average).alias("ltfc_flag"),
    )


def scoped_tickets_sql(kpi):
    """Tickets with the level that lists their project; ``level`` of the ticket itself plays no part."""
    return f"(SELECT r.level, i.* EXCLUDE (level) FROM incidents i JOIN ticket_rules r ON r.project = i.issue_project AND r.kpi = '{kpi}')"


@query("change_failure_rate_monthly", "D3 D6", "flat ticket_rules incidents", f"""
SELECT level, {YM.format('p')} AS year_month, n AS cfr_total_changes, f AS cfr_total_failures,
  {rnd('CASE WHEN n > 0 THEN f * 100.0 / n ELSE 0 END')} AS cfr_value, {band_sql('cfr', rnd('CASE WHEN n > 0 THEN f * 100.0 / n ELSE 0 END'))} AS cfr_flag
FROM (SELECT level, date_trunc('month', issue_created) AS p, count(cfr_total_changes_key) AS n, count(cfr_total_failures_key) AS f
  FROM {scoped_tickets_sql('kpi-cfr')} WHERE issue_resolution_date IS NOT NULL GROUP BY level, p)""")
def _(t):
    sums = per_level(dl.tickets_in_scope(t.incidents, dl.ticket_rules(scope(t), TICKETS), "kpi-cfr", None, "month"))
    rate = F.round(F.coalesce(ratio(F.col("cfr_total_failures"), F.col("cfr_total_changes"), 100), F.lit(0.0)), 2)
    return sums.select(
        "level", year_month("period").alias("year_month"), "cfr_total_changes", "cfr_total_failures", rate.alias("cfr_value"),
        band("cfr", rate).alias("cfr_flag"),
    )


MTTR_AVG = rnd("s / (r * 3600.0)")


@query("time_to_restore_monthly", "D4 D6", "flat ticket_rules incidents", f"""
SELECT level, {YM.format('p')} AS year_month, n AS total_incidents, r AS resolved_incidents,
  CASE WHEN r > 0 THEN {MTTR_AVG} END AS avg_mttr, {band_sql('mttr', f'(CASE WHEN r > 0 THEN {MTTR_AVG} END)')} AS mttr_flag
FROM (SELECT level, date_trunc('month', issue_created) AS p, count(*) AS n, count(issue_resolution_date) AS r,
    sum({secs('issue_created', 'issue_resolution_date')}) AS s FROM {scoped_tickets_sql('kpi-mttr')} WHERE mttr_issue_key IS NOT NULL GROUP BY level, p)""")
def _(t):
    sums = per_level(dl.tickets_in_scope(t.incidents, dl.ticket_rules(scope(t), TICKETS), None, "kpi-mttr", "month"))
    average = F.round(ratio(F.col("total_mttr_seconds"), F.col("resolved_incidents") * 3600), 2)
    return sums.select(
        "level", year_month("period").alias("year_month"), "total_incidents", "resolved_incidents", average.alias("avg_mttr"),
        band("mttr", average).alias("mttr_flag"),
    )


CYCLE = f"""SELECT * FROM (SELECT *, date_diff('day', issue_created, issue_updated) AS cycle_days,
    row_number() OVER (PARTITION BY issue_key ORDER BY issue_updated DESC, change_id DESC) AS rn FROM issue_history s
  WHERE lower(issue_changelog_itemsfield) IN ('status', 'epic status')
    AND CAST(issue_updated AS DATE) BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}' AND {CTFC_MATCH}) WHERE rn = 1"""


# The same per level of the hierarchy that lists an issue.
CYCLE_BY_LEVEL = f"""SELECT * FROM (SELECT f.level_3 AS level, s.team, s.issue_updated, date_diff('day', issue_created, issue_updated) AS cycle_days,
    row_number() OVER (PARTITION BY f.level_3, s.issue_key ORDER BY issue_updated DESC, change_id DESC) AS rn
  FROM issue_history s JOIN flat f ON {CTFC_ROW}
  WHERE lower(issue_changelog_itemsfield) IN ('status', 'epic status') AND CAST(issue_updated AS DATE) BETWEEN DATE '{WINDOW[0]}' AND DATE '{WINDOW[1]}') WHERE rn = 1"""


def cycle_issues(t):
    return dl.cycle_time_issues(t.issue_history, ctfc_filters(t), *WINDOW)


def cycle_issues_by_level(t):
    listed = scope(t).filter(fl.in_scope("kpi-ctfc")).withColumn("level", F.col("level_3"))
    return dl.cycle_time_issues(t.issue_history, listed, *WINDOW, carry=["level"])


@query("cycle_time_per_issue", "D5", "flat issue_history", f"""
SELECT issue_key, issue_status, CAST(issue_updated AS DATE) AS updated, CAST(cycle_days AS INTEGER) AS cycle_days FROM ({CYCLE})""")
def _(t):
    return cycle_issues(t).select("issue_key", "issue_status", F.to_date("issue_updated").alias("updated"), "cycle_days")


@query("cycle_time_monthly", "D5 D6", "flat issue_history", f"""
SELECT level, {YM.format('p')} AS year_month, n AS ctfc_count_issues, {rnd('d * 1.0 / n')} AS ctfc_value,
  {band_sql('ltfc', rnd('d * 1.0 / n'))} AS ctfc_flag FROM (SELECT level, date_trunc('month', issue_updated) AS p, count(*) AS n,
  sum(cycle_days) AS d FROM ({CYCLE_BY_LEVEL}) GROUP BY level, p)""")
def _(t):
    sums = dl.cycle_time(cycle_issues_by_level(t), "month", keys=("level",))
    value = F.round(ratio(F.col("total_ctfc"), F.col("ctfc_count_issues")), 2)
    return sums.select(
        "level", year_month("period").alias("year_month"), "ctfc_count_issues", value.alias("ctfc_value"),
        band("ctfc", value).alias("ctfc_flag"),
    )


# ---- scorecards ----------------------------------------------------------------------------------------------------


METRICS = ("df", "ltfc", "cfr", "mttr", "ctfc")


def parts(t, grain, metrics):
    """The additive measures of the metrics, all of them for the population that the hierarchy gives each level."""
    flat_ = scope(t)
    if "df" in metrics:
        yield dl.frequency_in_scope(t.deploys, dl.deploy_rules(flat_), "kpi-df", grain)
    if "ltfc" in metrics:
        yield dl.lead_time_in_scope(t.deploys, t.deploy_commits, dl.deploy_rules(flat_), "kpi-ltfc", grain).drop("commits_after_deploy")
    wanted = [k if k.removeprefix("kpi-") in metrics else None for k in TICKETS]
    if any(wanted):
        yield dl.tickets_in_scope(t.incidents, dl.ticket_rules(flat_, TICKETS), *wanted, grain)
    if "ctfc" in metrics:
        yield dl.cycle_time(cycle_issues_by_level(t), grain)


def sums(t, grain, metrics=METRICS, window=None):
    per_team = dl.combine(list(parts(t, grain, metrics)))
    if window:
        # The period is a grouping key, so Catalyst moves this filter below the aggregates and joins to the scans.
        per_team = per_team.filter(F.col("period").between(F.lit(window[0]).cast("date"), F.lit(window[1]).cast("date")))
    return dl.with_sublevels(per_team)


SCORE_USES = "flat deploy_rules ticket_rules deploys deploy_commits incidents issue_history"


def sums_sql(grain):
    zero = {
        "success_deployments": "0", "failed_deployments": "0", "commits_count": "0", "total_ltfc": "0", "cfr_total_changes": "0",
        "cfr_total_failures": "0", "total_incidents": "0", "resolved_incidents": "0", "total_mttr_seconds": "0",
        "ctfc_count_issues": "0", "total_ctfc": "0",
    }

    def arm(period, source, **cols):
        picked = ", ".join(f"{e} AS {n}" for n, e in {**zero, **cols}.items())
        return f"SELECT level, team, {trunc(grain, period)} AS period, {picked} FROM {source}"

    arms = [
        arm("pipeline_started_at", f"{scoped_deploys_sql('kpi-df')} WHERE good OR pipeline_status = 'failed'",
            success_deployments="CASE WHEN good THEN 1 ELSE 0 END", failed_deployments="CASE WHEN good THEN 0 ELSE 1 END"),
        arm("pipeline_started_at", f"{scoped_deploys_sql('kpi-ltfc')} JOIN deploy_commits ON pipeline_commit_sha = to_sha WHERE good",
            commits_count="1", total_ltfc="date_diff('day', committed_date, pipeline_started_at)"),
        arm("issue_created", f"{scoped_tickets_sql('kpi-cfr')} WHERE issue_resolution_date IS NOT NULL", cfr_total_changes="1",
            cfr_total_failures="CASE WHEN cfr_total_failures_key IS NULL THEN 0 ELSE 1 END"),
        arm("issue_created", f"{scoped_tickets_sql('kpi-mttr')} WHERE mttr_issue_key IS NOT NULL", total_incidents="1",
            resolved_incidents="CASE WHEN issue_resolution_date IS NULL THEN 0 ELSE 1 END",
            total_mttr_seconds=f"coalesce({secs('issue_created', 'issue_resolution_date')}, 0)"),
        arm("issue_updated", f"({CYCLE_BY_LEVEL})", ctfc_count_issues="1", total_ctfc="cycle_days"),
    ]
    agg = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in zero)
    return f"""SELECT level, team AS sub_level, grouping(team) = 1 AS is_total, period, {agg} FROM ({' UNION ALL '.join(arms)})
      GROUP BY GROUPING SETS ((level, period), (level, team, period))"""


def score_sql(grain):
    ltfc = f"CASE WHEN commits_count > 0 THEN {rnd('total_ltfc * 1.0 / commits_count')} END"
    cfr = f"CASE WHEN cfr_total_changes > 0 THEN {rnd('cfr_total_failures * 100.0 / cfr_total_changes')} ELSE 0.0::DOUBLE END"
    mttr = f"CASE WHEN resolved_incidents > 0 THEN {rnd('total_mttr_seconds / (resolved_incidents * 3600.0)')} END"
    ctfc = f"CASE WHEN ctfc_count_issues > 0 THEN {rnd('total_ctfc * 1.0 / ctfc_count_issues')} END"
    total = "(success_deployments + failed_deployments)"
    label = f"{MONTH_NAME.format('period')} AS month_name" if grain == "month" else f"{WEEK_NAME.format('period')} AS week_name"
    return f"""SELECT *, {total} AS total_deployments, {ltfc} AS average_ltfc, {cfr} AS cfr_value, {mttr} AS avg_mttr, {ctfc} AS ctfc_value,
      {band_sql('df', total)} AS df_flag, {band_sql('ltfc', f'({ltfc})')} AS ltfc_flag, {band_sql('cfr', f'({cfr})')} AS cfr_flag,
      {band_sql('mttr', f'({mttr})')} AS mttr_flag, {band_sql('ltfc', f'({ctfc})')} AS ctfc_flag, {YM.format('period')} AS year_month, {label}
      FROM ({sums_sql(grain)})"""


query("scorecard_monthly", "D7 D11", SCORE_USES, score_sql("month"))(lambda t: dl.monthly_scorecard(sums(t, "month")))
query("scorecard_weekly", "D8 D11", SCORE_USES, score_sql("week"))(lambda t: dl.weekly_scorecard(sums(t, "week")))

FIRST_COUNT = {m: dl.METRIC_COLUMNS[m][0] for m in METRICS} | {"df": "success_deployments + failed_deployments"}

for grain, label, card in (("month", "month_name", dl.monthly_scorecard), ("week", "week_name", dl.weekly_scorecard)):
    for metric, columns in dl.METRIC_COLUMNS.items():
        query(
            f"scorecard_{metric}_{grain}ly",
            "D10",
            SCORE_USES,
            f"SELECT level, sub_level, year_month, {label}, {', '.join(columns)} FROM ({score_sql(grain)}) WHERE {FIRST_COUNT[metric]} > 0",
        )(lambda t, g=grain, label=label, card=card, m=metric: dl.metric_table(card(sums(t, g, (m,))), m, label))

DAYS = ("1998-01-01", "1998-03-31")


@query("scorecard_daily_snapshot", "D9", SCORE_USES, f"""
WITH s AS ({sums_sql('day')})
SELECT k.level, k.sub_level, k.is_total, d.day AS date, {', '.join(f'coalesce(s.{m}, 0) AS {m}' for m in dl.ADDITIVE)}
FROM (SELECT DISTINCT level, sub_level, is_total FROM s WHERE period BETWEEN DATE '{DAYS[0]}' AND DATE '{DAYS[1]}') k CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '{DAYS[0]}', DATE '{DAYS[1]}', INTERVAL 1 DAY)) AS DATE) AS day) d
LEFT JOIN s ON s.level = k.level AND s.sub_level IS NOT DISTINCT FROM k.sub_level AND s.is_total = k.is_total AND s.period = d.day""")
def _(t):
    return dl.daily_snapshot(sums(t, "day", window=DAYS), *DAYS)


@query("deployments_before_and_after", "D13", "deploys", f"""
SELECT level, CASE WHEN CAST(pipeline_started_at AS DATE) < DATE '1998-06-01' THEN 'before' ELSE 'after' END AS phase, count(*) AS runs,
  {rnd("count(*) FILTER (pipeline_status = 'failed') * 100.0 / count(*)")} AS failed_percent FROM deploys GROUP BY level, phase""")
def _(t):
    measures = [
        F.count("*").alias("runs"),
        F.round(ratio(F.count_if(F.col("pipeline_status") == "failed"), F.count("*"), 100), 2).alias("failed_percent"),
    ]
    return dl.compare_phases(t.deploys, "pipeline_started_at", "1998-06-01", measures, ["level"])


@query("deploy_chain", "D14", "deploys", """
SELECT project_name, run_id, pipeline_commit_sha, lag(pipeline_commit_sha) OVER (PARTITION BY project_name ORDER BY pipeline_started_at, run_id) AS from_sha
FROM deploys WHERE pipeline_status = 'success'""")
def _(t):
    return dl.deploy_chain(t.deploys).select("project_name", "run_id", "pipeline_commit_sha", "from_sha")


@query("activity_by_status_and_step", "D15", "deploys", """
SELECT pipeline_status, pipeline_source, step_type, count(*) AS n FROM deploys WHERE level IN ('NATION_1', 'NATION_2', 'NATION_3')
GROUP BY pipeline_status, pipeline_source, step_type""")
def _(t):
    scoped = t.deploys.filter(F.col("level").isin("NATION_1", "NATION_2", "NATION_3"))
    return dl.activity_counts(scoped, ["pipeline_status", "pipeline_source", "step_type"])


@query("release_age_windows", "D16", "releases", """
SELECT CASE WHEN a < 0 THEN 'upcoming' WHEN a <= 30 THEN 'last 30 days' WHEN a <= 90 THEN 'last 90 days' WHEN a <= 365 THEN 'last 365 days'
  ELSE 'older' END AS age_window, count(*) AS releases, CAST(min(a) AS INTEGER) AS youngest
FROM (SELECT date_diff('day', release_date, DATE '2001-06-30') AS a FROM releases) GROUP BY age_window""")
def _(t):
    aged = dl.release_age(t.releases, "2001-06-30")
    return aged.groupBy("age_window").agg(F.count("*").alias("releases"), F.min("age_days").alias("youngest"))
