"""Queries over assistant usage, seats and licences."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgauge.operators import assist as aa
from flowgauge.operators import filters as fl
from flowgauge.plans.registry import query, rnd, secs
from flowgauge.plans.scope import flat

SUM_SQL = ", ".join(f"CAST(sum({s}) AS BIGINT) AS {s}" for s in aa.SUMS)
GEN, ACC = aa.SUMS[1], aa.SUMS[2]


@query("usage_org_day", "A1", "assist", f"""
SELECT usage_date, org_name, {SUM_SQL}, count(DISTINCT user_login) AS daily_active_users,
  count(DISTINCT CASE WHEN used_chat THEN user_login END) AS daily_chat_users,
  count(DISTINCT CASE WHEN used_agent THEN user_login END) AS daily_agent_users FROM assist GROUP BY usage_date, org_name""")
def _(t):
    return aa.org_day(aa.user_day(t.assist))


NESTS = {
    "ide": ("A2", ("ide",)),
    "feature": ("A3", ("feature",)),
    "language_feature": ("A3", ("language", "feature")),
    "language_model": ("A3", ("language", "model")),
    "model_feature": ("A3", ("model", "feature")),
}
for label, (row, dims) in NESTS.items():
    text = " || '/' || ".join(dims)
    query(f"usage_nested_by_{label}", row, "assist", f"""
    SELECT usage_date, count(*) AS entries, string_agg({text} || '=' || g || ':' || a, ',' ORDER BY {', '.join(dims)}) AS totals
    FROM (SELECT usage_date, {', '.join(dims)}, CAST(sum({GEN}) AS BIGINT) AS g, CAST(sum({ACC}) AS BIGINT) AS a FROM assist
      GROUP BY usage_date, {', '.join(dims)}) GROUP BY usage_date""")(
        lambda t, dims=dims: aa.nest_totals(t.assist, dims, "totals").select(
            "usage_date",
            F.size("totals").cast("bigint").alias("entries"),
            F.array_join(
                F.transform(
                    "totals",
                    lambda x: F.concat(
                        F.concat_ws("/", *[x[d] for d in dims]), F.lit("="), x[GEN].cast("string"), F.lit(":"), x[ACC].cast("string")
                    ),
                ),
                ",",
            ).alias("totals"),
        )
    )


@query("usage_nested_read_back", "A4", "assist", f"""
SELECT usage_date, language, model, CAST(sum({GEN}) AS BIGINT) AS {GEN}, CAST(sum({ACC}) AS BIGINT) AS {ACC} FROM assist
GROUP BY usage_date, language, model""")
def _(t):
    return aa.unnest_totals(aa.nest_totals(t.assist, ("language", "model"), "totals"), "totals")


ROLLUPS = {
    "usage_user_feature_day": ("A5", ("usage_date", "user_login", "feature")),
    "usage_user_ide_day": ("A5", ("usage_date", "user_login", "ide")),
    "usage_user_language_model_day": ("A5", ("usage_date", "user_login", "language", "model")),
}
for name, (row, dims) in ROLLUPS.items():
    query(name, row, "assist", f"SELECT {', '.join(dims)}, {SUM_SQL} FROM assist GROUP BY {', '.join(dims)}")(
        lambda t, dims=dims: aa.rollup(t.assist, dims)
    )


@query("usage_org_language_ide_day", "A6", "assist", f"""
SELECT usage_date, language, ide, CAST(sum({GEN}) AS BIGINT) AS suggestions, CAST(sum({ACC}) AS BIGINT) AS acceptances,
  CAST(sum(CASE WHEN used_chat THEN user_initiated_interaction_count ELSE 0 END) AS BIGINT) AS chats,
  count(DISTINCT user_login) AS engaged_users FROM assist GROUP BY usage_date, language, ide""")
def _(t):
    chats = F.sum(F.when(F.col("used_chat"), F.col(aa.SUMS[0])).otherwise(0))
    return t.assist.groupBy("usage_date", "language", "ide").agg(
        F.sum(GEN).alias("suggestions"), F.sum(ACC).alias("acceptances"), chats.alias("chats"),
        F.count_distinct("user_login").alias("engaged_users"),
    )


@query("acceptance_totals_by_tool_day", "A7", "assist", f"""
SELECT tool, usage_date, CAST(sum({GEN}) AS BIGINT) AS {GEN}, CAST(sum({ACC}) AS BIGINT) AS {ACC},
  CAST(sum(loc_suggested_to_add_sum) AS BIGINT) AS loc_suggested_to_add_sum, CAST(sum(loc_added_sum) AS BIGINT) AS loc_added_sum
FROM assist GROUP BY tool, usage_date""")
def _(t):
    return aa.rollup(t.assist, ["tool", "usage_date"], (GEN, ACC, "loc_suggested_to_add_sum", "loc_added_sum"))


RATE = f"""CAST(sum({ACC}) AS BIGINT) AS accepted, CAST(sum({GEN}) AS BIGINT) AS generated,
  {rnd(f'CAST(sum({ACC}) AS DOUBLE) * 100 / nullif(sum({GEN}), 0)')} AS acceptance_percent"""


@query("acceptance_rate_by_language", "A8", "assist", f"SELECT language, {RATE} FROM assist GROUP BY language")
def _(t):
    return aa.acceptance_rate(["language"], t.assist)


@query("acceptance_rate_overall", "A8", "assist", f"SELECT {RATE} FROM assist")
def _(t):
    return aa.acceptance_rate([], t.assist)


CATEGORIES = {"programmingLanguage": "language", "editor": "ide", "ide_model": "model"}
EAV = " UNION ALL ".join(
    f"""SELECT usage_date, org_name, '{n}' AS param_name, {c} AS parameter, CAST(sum(loc_suggested_to_add_sum) AS BIGINT) AS total_lines_suggested,
    CAST(sum(loc_added_sum) AS BIGINT) AS total_lines_accepted FROM assist GROUP BY usage_date, org_name, {c}"""
    for n, c in CATEGORIES.items()
)


@query("usage_long_by_category", "A9", "assist", EAV)
def _(t):
    return aa.to_eav(t.assist, CATEGORIES)


@query("usage_long_top_values", "A10", "assist", f"""
SELECT * FROM (SELECT param_name, parameter, count(*) AS n_rows, CAST(sum(total_lines_suggested) AS BIGINT) AS total_suggested,
  CAST(sum(total_lines_accepted) AS BIGINT) AS total_accepted,
  CAST(row_number() OVER (PARTITION BY param_name ORDER BY count(*) DESC, parameter) AS INTEGER) AS position FROM ({EAV})
  GROUP BY param_name, parameter) WHERE position <= 3""")
def _(t):
    return aa.eav_top(aa.to_eav(t.assist, CATEGORIES), 3)


@query("lines_split_evenly_over_users", "A11", "assist", """
SELECT org_name, user_id, total, total // n + CASE WHEN pos < total % n THEN 1 ELSE 0 END AS share FROM (
  SELECT org_name, user_id, row_number() OVER (PARTITION BY org_name ORDER BY user_id) - 1 AS pos, count(*) OVER (PARTITION BY org_name) AS n,
    CAST(sum(l) OVER (PARTITION BY org_name) AS BIGINT) AS total FROM (SELECT org_name, user_id, sum(loc_added_sum) AS l FROM assist GROUP BY org_name, user_id))""")
def _(t):
    users = t.assist.select("org_name", "user_id").distinct()
    totals = t.assist.groupBy("org_name").agg(F.sum("loc_added_sum").alias("total"))
    joined = users.join(totals, "org_name")
    return aa.split_even(joined, ["org_name"], "total", "user_id", F.expr("user_id div 100"))


@query("seats_apportioned_by_usage", "A12", "assist", f"""
WITH p AS (SELECT org_name, language, CAST(sum({GEN}) AS BIGINT) AS w, 1000 + CAST(length(org_name) AS BIGINT) AS total FROM assist GROUP BY org_name, language),
q AS (SELECT *, CAST(sum(w) OVER (PARTITION BY org_name) AS BIGINT) AS s FROM p),
r AS (SELECT *, (total * w) // s AS f, (total * w) % s AS rest FROM q)
SELECT org_name, language, w AS {GEN}, total, f + CASE WHEN row_number() OVER (PARTITION BY org_name ORDER BY rest DESC, language)
  <= total - CAST(sum(f) OVER (PARTITION BY org_name) AS BIGINT) THEN 1 ELSE 0 END AS share FROM r""")
def _(t):
    usage = t.assist.withColumn("total", F.lit(1000) + F.length("org_name"))
    return aa.apportion(usage, ["org_name"], "language", GEN, "total")


@query("allocated_seats_as_of_day", "A13 A14", "assist seats", """
WITH u AS (SELECT org_name, usage_date, count(DISTINCT user_login) AS active FROM assist GROUP BY org_name, usage_date),
a AS (SELECT u.*, (SELECT count(*) FROM seats s WHERE s.org_name = u.org_name AND s.created_at <= u.usage_date) AS n FROM u)
SELECT org_name, usage_date, nullif(n, 0) AS total_seats, least(active, n) AS active_seats, n - least(active, n) AS inactive_seats FROM a""")
def _(t):
    users = t.assist.groupBy("org_name", "usage_date").agg(F.count_distinct("user_login").alias("active"))
    steps = aa.allocation_steps(t.seats)
    joined = aa.as_of(users, steps, ["org_name"], "usage_date", "allocated")
    split = aa.billing_snapshot(F.col("allocated"), F.col("active"))
    return joined.select("org_name", "usage_date", *[e.alias(n) for n, e in split.items()])


@query("seat_activity_by_day", "A15", "assist seats", """
WITH d AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS usage_date),
r AS (SELECT org_name, assignee_login, usage_date FROM seats JOIN d ON created_at <= usage_date),
a AS (SELECT user_login, usage_date, count(*) AS n FROM assist GROUP BY user_login, usage_date)
SELECT r.org_name, r.usage_date, count(*) AS seats, count(a.n) AS active, count(*) - count(a.n) AS inactive, CAST(sum(a.n) AS BIGINT) AS interactions
FROM r LEFT JOIN a ON r.assignee_login = a.user_login AND r.usage_date = a.usage_date GROUP BY r.org_name, r.usage_date""")
def _(t):
    return aa.seat_activity(t.seats, t.assist, "2024-01-01", "2024-01-30")


@query("heavy_users", "A16", "assist", f"""
SELECT org_name, user_login, count(DISTINCT usage_date) AS active_days, {rnd('count(DISTINCT usage_date) / 22.0', 4)} AS active_share
FROM assist WHERE isodow(usage_date) < 6 AND usage_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
GROUP BY org_name, user_login HAVING count(DISTINCT usage_date) >= 0.75 * 22""")
def _(t):
    return aa.heavy_users(t.assist, "2024-01-01", "2024-01-30")


def tool_days(t):
    rosters = t.assist.groupBy("tool").agg(F.count_distinct("user_login").alias("roster"))
    active = t.assist.groupBy("tool", "usage_date").agg(F.count_distinct("user_login").alias("active"))
    return active.join(rosters, "tool")


TOOL_DAYS = """SELECT tool, usage_date, active, roster FROM (SELECT tool, usage_date, count(DISTINCT user_login) AS active FROM assist GROUP BY tool, usage_date)
  JOIN (SELECT tool, count(DISTINCT user_login) AS roster FROM assist GROUP BY tool) USING (tool)"""


@query("licence_adoption_by_tool_day", "A17", "assist", f"""
SELECT tool, usage_date, roster AS allocated_licenses, active AS licenses_active_in_cycle, {rnd('active * 100.0 / roster')} AS adoption_percent,
  roster - active AS unused_licenses FROM ({TOOL_DAYS})""")
def _(t):
    allocated, active = F.col("roster"), F.col("active")
    return tool_days(t).select(
        "tool", "usage_date", allocated.alias("allocated_licenses"), active.alias("licenses_active_in_cycle"),
        *[e.alias(n) for n, e in aa.adoption(allocated, active).items()],
    )


@query("licence_ramp_by_tool_day", "A18", "assist", f"""
SELECT tool, usage_date, roster, CASE WHEN usage_date < DATE '2024-01-06' THEN 0 ELSE CAST(round(CAST(roster * least(date_diff('day', DATE '2024-01-06', usage_date) + 1, 20) AS DOUBLE) / 20) AS BIGINT) END AS quota
FROM ({TOOL_DAYS})""")
def _(t):
    quota = aa.ramp("usage_date", F.lit("2024-01-06").cast("date"), "roster", 20)
    return tool_days(t).select("tool", "usage_date", "roster", quota.alias("quota"))


@query("lines_split_chat_and_ide", "A19", "assist", """
SELECT org_name, usage_date, CAST(sum(loc_added_sum) AS BIGINT) AS total_lines, CAST(coalesce(sum(loc_added_sum) FILTER (used_chat), 0) AS BIGINT) AS chat_lines,
  CAST(coalesce(sum(loc_added_sum) FILTER (NOT used_chat), 0) AS BIGINT) AS ide_lines, true AS parts_sum_to_total FROM assist GROUP BY org_name, usage_date""")
def _(t):
    lines = F.col("loc_added_sum")
    out = t.assist.groupBy("org_name", "usage_date").agg(
        F.sum(lines).alias("total_lines"),
        F.sum(F.when(F.col("used_chat"), lines).otherwise(0)).alias("chat_lines"),
        F.sum(F.when(~F.col("used_chat"), lines).otherwise(0)).alias("ide_lines"),
    )
    return out.withColumn("parts_sum_to_total", F.col("chat_lines") + F.col("ide_lines") == F.col("total_lines"))


@query("weekly_engaged_users", "A20", "assist", """
SELECT CAST(date_trunc('week', usage_date) AS DATE) AS week, tool, language, count(DISTINCT user_login) AS engaged_users FROM assist GROUP BY week, tool, language""")
def _(t):
    return aa.engaged_users(t.assist, ["tool", "language"])


@query("weekly_tool_model_language_matrix", "A21", "assist", f"""
SELECT week, tool, model, language, grouping(week, tool, model, language) AS grouping_bits, CAST(sum({GEN}) AS BIGINT) AS generated,
  CAST(sum({ACC}) AS BIGINT) AS accepted, count(DISTINCT user_login) AS engaged_users
FROM (SELECT *, CAST(date_trunc('week', usage_date) AS DATE) AS week FROM assist) GROUP BY week, CUBE (tool, model, language)""")
def _(t):
    return aa.weekly_matrix(t.assist, ["tool", "model", "language"])


@query("tool_picker", "A22", "flat", "SELECT DISTINCT coalesce(tool_type, 'x') AS tool FROM flat WHERE kpi = 'kpi-assist'")
def _(t):
    named = fl.scope_values_outer(flat(t, "org_name", "team_names"), ["org_name", "team_names"], "kpi-assist")
    return named.select(F.coalesce("tool_type", F.lit(fl.ANY)).alias("tool")).distinct()


@query("tool_date_range", "A23", "assist", """
SELECT tool, count(*) AS n_rows, min(usage_date) AS first_day, max(usage_date) AS last_day FROM assist GROUP BY tool""")
def _(t):
    return t.assist.groupBy("tool").agg(
        F.count("*").alias("n_rows"), F.min("usage_date").alias("first_day"), F.max("usage_date").alias("last_day")
    )


@query("commit_integration_rate", "A24", "commits_prs", f"""
SELECT tool, count(DISTINCT commit_id) AS tagged_commits, {rnd('count(DISTINCT commit_id) * 100.0 / (SELECT count(DISTINCT commit_id) FROM commits_prs)')} AS integration_percent
FROM (SELECT commit_id, unnest(ai_tool) AS tool FROM commits_prs) GROUP BY tool""")
def _(t):
    return aa.integration_rate(t.commits_prs)


@query("tool_velocity", "A25", "commits_prs", f"""
SELECT tool, count(*) AS pull_requests, count(*) FILTER (f > c) AS opened_before_first_commit, {rnd(f"sum({secs('f', 'c')}) / (count(*) * 3600.0)")} AS mean_hours FROM (
  SELECT tool, pr_id, pr_created_datetime AS c, min(commit_timestamp) AS f FROM (SELECT *, unnest(ai_tool) AS tool FROM commits_prs)
  GROUP BY tool, pr_id, pr_created_datetime) GROUP BY tool""")
def _(t):
    return aa.tool_velocity(t.commits_prs)


@query("tool_quality", "A26", "commits_prs issues", f"""
SELECT tool, count(DISTINCT commit_id) AS commits, count(DISTINCT CASE WHEN bug THEN commit_id END) AS bug_commits,
  {rnd('count(DISTINCT CASE WHEN bug THEN commit_id END) * 100.0 / count(DISTINCT commit_id)')} AS bug_percent FROM (
  SELECT commit_id, unnest(ai_tool) AS tool, commit_id IN (SELECT x.commit_id FROM (SELECT commit_id, unnest(commit_tickets) AS k FROM commits_prs) x
    JOIN issues i ON i.issue_key = x.k WHERE i.issue_type = 'Bug') AS bug FROM commits_prs) GROUP BY tool""")
def _(t):
    return aa.tool_quality(t.commits_prs, t.issues)


@query("tool_security", "A27", "commits_prs deploys secret_scans", """
SELECT tool, count(*) AS scanned_merges, CAST(sum(total_issues) AS BIGINT) AS findings FROM (SELECT DISTINCT unnest(ai_tool) AS tool, merge_commit_sha FROM commits_prs) m
JOIN deploys d ON m.merge_commit_sha = d.pipeline_commit_sha JOIN secret_scans s ON s.scan_id = concat('scan-', d.run_id) GROUP BY tool""")
def _(t):
    return aa.tool_security(t.commits_prs, t.deploys, t.secret_scans)


@query("engagement_by_organisation", "A28", "assist", f"""
SELECT org_name, count(*) AS active_users, {rnd('sum(f) * 1.0 / count(*)')} AS features_per_user, {rnd('sum(d) * 1.0 / count(*)')} AS active_days_per_user
FROM (SELECT org_name, user_login, count(DISTINCT feature) AS f, count(DISTINCT usage_date) AS d FROM assist GROUP BY org_name, user_login) GROUP BY org_name""")
def _(t):
    return aa.engagement(t.assist)


@query("feature_active_users", "A28", "assist", """
SELECT org_name, feature, count(DISTINCT user_login) AS active_users FROM assist GROUP BY org_name, feature""")
def _(t):
    return t.assist.groupBy("org_name", "feature").agg(F.count_distinct("user_login").alias("active_users"))


@query("trailing_active_users", "A29", "assist", """
WITH o AS (SELECT DISTINCT org_name FROM assist), d AS (SELECT CAST(unnest(generate_series(DATE '2024-01-03', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT o.org_name, d.day AS usage_date, count(DISTINCT CASE WHEN usage_date = day THEN user_login END) AS dau,
  count(DISTINCT CASE WHEN usage_date BETWEEN day - 6 AND day THEN user_login END) AS wau,
  count(DISTINCT CASE WHEN usage_date BETWEEN day - 27 AND day THEN user_login END) AS mau
FROM o CROSS JOIN d LEFT JOIN assist a ON a.org_name = o.org_name AND a.usage_date BETWEEN d.day - 27 AND d.day GROUP BY o.org_name, d.day""")
def _(t):
    return aa.trailing_users(t.assist, {"dau": 1, "wau": 7, "mau": 28}, "2024-01-03", "2024-01-30")


@query("weekly_user_snapshot", "A30", "assist", """
SELECT DISTINCT CAST(date_trunc('week', usage_date) AS DATE) AS week, org_name, tool, user_login FROM assist""")
def _(t):
    return aa.weekly_users(t.assist)


@query("stable_user_sample_by_tool", "A31", "assist", """
SELECT tool, user_login FROM (SELECT tool, user_login, row_number() OVER (PARTITION BY tool ORDER BY md5(user_login), user_login) AS rn
  FROM (SELECT DISTINCT tool, user_login FROM assist)) WHERE rn <= 25""")
def _(t):
    return aa.sample_n(t.assist.select("tool", "user_login").distinct(), 25, "user_login", ["tool"])
