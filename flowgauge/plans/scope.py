"""Queries over the semantic filter layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgauge.operators import filters as fl
from flowgauge.plans.registry import query


def rows(t):
    return fl.filter_rows(t.filter_groups, t.filter_values)


def flat(t, *names):
    return fl.flatten_filters(t.filter_groups, t.filter_values, *([names] if names else []))


@query("filters_flattened", "F1", "flat", """
SELECT filter_group_id, level_1, level_3, tool_type, kpi, array_to_string(project_url, ',') AS project_url,
  array_to_string(issue_status, ',') AS issue_status, array_to_string(board_ids, ',') AS board_ids,
  array_to_string(project_name, ',') AS project_name, array_to_string(include_issue_status, ',') AS include_issue_status,
  array_to_string(exclude_issue_status, ',') AS exclude_issue_status FROM flat""")
def _(t):
    arrays = ("project_url", "issue_status", "board_ids", "project_name", "include_issue_status", "exclude_issue_status")
    return flat(t).select(
        "filter_group_id", "level_1", "level_3", "tool_type", "kpi", *[F.array_join(c, ",").alias(c) for c in arrays]
    )


@query("deploys_in_scope", "F2 F7", "flat deploys", r"""
SELECT level, count(*) AS runs FROM deploys WHERE regexp_replace(project_url, '\.git$', '') IN (
  SELECT regexp_replace(u, '\.git$', '') FROM (SELECT unnest(project_url) AS u FROM flat WHERE kpi = 'kpi-df' AND level_1 = 'ASIA'))
GROUP BY level""")
def _(t):
    urls = fl.scope_values(rows(t), "project_url", "kpi-df", level_1="ASIA")
    return fl.url_semi_join(t.deploys, urls).groupBy("level").agg(F.count("*").alias("runs"))


@query("scope_values_by_level", "F2", "flat", """
SELECT DISTINCT unnest(project_name) AS project_name FROM flat WHERE kpi = 'kpi-ctfc' AND level_4 = 'area-1'""")
def _(t):
    return fl.scope_values(rows(t), "project_name", "kpi-ctfc", level_4="area-1")


OUTER = """SELECT DISTINCT tool_type, coalesce(o, 'x') AS org_name, coalesce(m, 'x') AS team_names
  FROM flat LEFT JOIN unnest(org_name) AS a(o) ON true LEFT JOIN unnest(team_names) AS b(m) ON true WHERE kpi = 'kpi-assist'"""


@query("scope_values_with_sentinel", "F3", "flat", OUTER)
def _(t):
    return fl.scope_values_outer(flat(t, "org_name", "team_names"), ["org_name", "team_names"], "kpi-assist")


def level_fact(t):
    """Assistant rows at two levels: organisation and team."""
    levels = F.array(
        F.struct(F.lit("organization").alias("level"), F.col("org_name").alias("level_name")),
        F.struct(F.lit("team").alias("level"), F.col("team_name").alias("level_name")),
    )
    return t.assist.select("tool", "usage_date", "loc_added_sum", F.inline(levels))


LEVEL_FACT = """SELECT tool, loc_added_sum, usage_date, 'organization' AS level, org_name AS level_name FROM assist
  UNION ALL SELECT tool, loc_added_sum, usage_date, 'team', team_name FROM assist"""


@query("accepted_lines_by_wildcard_scope", "F4", "flat assist", f"""
WITH f AS ({OUTER}), a AS ({LEVEL_FACT})
SELECT tool, level, level_name, count(*) AS n_rows, CAST(sum(loc_added_sum) AS BIGINT) AS lines_accepted
FROM a JOIN f ON f.tool_type = a.tool AND ((f.team_names <> 'x' AND a.level = 'team' AND a.level_name = f.team_names)
  OR (f.team_names = 'x' AND a.level = 'organization' AND (f.org_name = 'x' OR a.level_name = f.org_name)))
GROUP BY tool, level, level_name""")
def _(t):
    filt = fl.scope_values_outer(flat(t, "org_name", "team_names"), ["org_name", "team_names"], "kpi-assist")
    return (
        fl.wildcard_join(level_fact(t), filt)
        .groupBy("tool", "level", "level_name")
        .agg(F.count("*").alias("n_rows"), F.sum("loc_added_sum").alias("lines_accepted"))
    )


@query("accepted_lines_by_strict_scope", "F5", "flat assist", f"""
WITH f AS ({OUTER}), a AS ({LEVEL_FACT})
SELECT tool, level_name, count(*) AS n_rows FROM a JOIN f ON f.tool_type = a.tool AND a.level = 'organization'
  AND a.level_name = f.org_name GROUP BY tool, level_name""")
def _(t):
    filt = fl.scope_values_outer(flat(t, "org_name", "team_names"), ["org_name", "team_names"], "kpi-assist")
    return fl.strict_join(level_fact(t), filt).groupBy("tool", "level_name").agg(F.count("*").alias("n_rows"))


# Whether one filter row lists an issue, and whether any does.
CTFC_ROW = """(f.kpi = 'kpi-ctfc'
    AND (f.project_name IS NULL OR list_contains(f.project_name, s.issue_project))
    AND (f.board_ids IS NULL OR len(list_intersect(f.board_ids, list_transform(s.board_info, lambda b: CAST(b.board_id AS VARCHAR)))) > 0)
    AND (f.board_ids IS NOT NULL OR f.project_name IS NOT NULL) AND f.issue_status IS NOT NULL
    AND list_contains(f.issue_status, s.issue_status)
    AND (f.include_issue_types IS NULL OR list_contains(f.include_issue_types, s.issue_type)))"""
CTFC_MATCH = f"EXISTS (SELECT 1 FROM flat f WHERE {CTFC_ROW})"


def ctfc_filters(t):
    return flat(t, "project_name", "board_ids", "issue_status", "include_issue_types").filter(fl.in_scope("kpi-ctfc"))


def with_board_ids(df):
    return df.withColumn("board_ids", F.transform("board_info", lambda b: b["board_id"].cast("string")))


@query("issue_changes_by_array_filters", "F6", "flat issue_history", f"""
SELECT issue_project, issue_status, issue_type, count(*) AS n FROM issue_history s WHERE {CTFC_MATCH}
GROUP BY issue_project, issue_status, issue_type""")
def _(t):
    filt = ctfc_filters(t)
    return (
        fl.array_filter_join(with_board_ids(t.issue_history), filt)
        .groupBy("issue_project", "issue_status", "issue_type")
        .agg(F.count("*").alias("n"))
    )


@query("deploys_by_listed_repository", "F7", "flat deploys", r"""
SELECT f.level_3, f.tool_type, count(*) AS runs FROM deploys p JOIN (
  SELECT level_3, tool_type, unnest(project_url) AS u FROM flat WHERE kpi = 'kpi-ltfc') f
  ON p.project_url = f.u OR p.project_url = concat(f.u, '.git') OR concat(p.project_url, '.git') = f.u
GROUP BY f.level_3, f.tool_type""")
def _(t):
    urls = flat(t, "project_url").filter(fl.in_scope("kpi-ltfc")).select("level_3", "tool_type", F.explode("project_url").alias("filter_url"))
    joined = fl.url_join(t.deploys, urls, "project_url", "filter_url")
    return joined.groupBy("level_3", "tool_type").agg(F.count("*").alias("runs"))


@query("commits_by_url_prefix", "F8", "flat deploy_commits", r"""
SELECT f.u AS matched_url, count(*) AS commits, count(DISTINCT commit_id) AS distinct_commits FROM deploy_commits c JOIN (
  SELECT DISTINCT regexp_replace(u, '\.git$', '') AS u FROM (SELECT unnest(project_url) AS u FROM flat
  WHERE kpi = 'kpi-ltfc' AND level_1 IN ('ASIA', 'EUROPE'))) f ON c.web_url LIKE concat(f.u, '/commit/%') GROUP BY f.u""")
def _(t):
    urls = fl.scope_values(rows(t), "project_url", "kpi-ltfc", level_1=["ASIA", "EUROPE"])
    return (
        fl.commit_prefix_join(t.deploy_commits, urls)
        .groupBy("matched_url")
        .agg(F.count("*").alias("commits"), F.count_distinct("commit_id").alias("distinct_commits"))
    )


def offering_sql(cond):
    return f"""WITH s AS (SELECT *, sum(CASE WHEN level_2 LIKE 'off:%' THEN 1 ELSE 0 END) OVER () AS n_off
  FROM flat WHERE kpi = 'kpi-df')
SELECT d.level, count(*) AS runs FROM deploys d JOIN s ON d.level = s.level_3 WHERE {cond} GROUP BY d.level"""


def offering_plan(toggle, enabled):
    def plan(t):
        scope = fl.offering_filter(flat(t, "project_url", "deployment_stages", "pipeline_status_success").filter(fl.in_scope("kpi-df")), toggle, enabled, "level_2")
        d = t.deploys
        return d.join(scope, d["level"] == scope["level_3"]).groupBy("level").agg(F.count("*").alias("runs"))

    return plan


query("deploys_of_offerings", "F9", "flat deploys", offering_sql(
    "CASE WHEN n_off > 0 THEN level_2 LIKE 'off:%' ELSE level_2 NOT LIKE 'off:%' END"))(offering_plan(True, True))
query("deploys_without_offerings", "F9", "flat deploys", offering_sql("level_2 NOT LIKE 'off:%'"))(offering_plan(True, False))
query("deploys_offering_toggle_off", "F9", "flat deploys", offering_sql("true"))(offering_plan(False, False))


@query("survey_answers_by_any_level", "F10", "survey filter_groups", """
SELECT g.filter_group_id, count(*) AS answers FROM (SELECT unnest(filters.level_3) AS v FROM survey UNION ALL
  SELECT unnest(filters.level_1) FROM survey) s JOIN filter_groups g
  ON s.v = g.level_1 OR s.v = g.level_2 OR s.v = g.level_3 OR s.v = g.level_4 GROUP BY g.filter_group_id""")
def _(t):
    values = t.survey.select(F.explode(F.concat("filters.level_3", "filters.level_1")).alias("level_value"))
    groups = t.filter_groups.select("filter_group_id", "level_1", "level_2", "level_3", "level_4")
    joined = fl.level_any_join(values, groups, "level_value")
    return joined.groupBy("filter_group_id").agg(F.count("*").alias("answers"))


@query("survey_answers_of_level", "F11 F12", "survey", """
SELECT survey_id, count(*) AS answers, count(DISTINCT response_id) AS responses FROM survey
WHERE list_has_any(filters.level_3, ['NATION_3', 'NATION_8']) GROUP BY survey_id""")
def _(t):
    long = fl.unpivot_levels(t.survey)
    return (
        fl.level_filter(long, "level_3", ["NATION_3", "NATION_8"])
        .groupBy("survey_id")
        .agg(F.count("*").alias("answers"), F.count_distinct("response_id").alias("responses"))
    )


@query("survey_levels_unpivoted", "F12", "survey", """
SELECT level_name, v AS value, count(*) AS answers FROM (
  SELECT 'level_1' AS level_name, unnest(filters.level_1) AS v FROM survey UNION ALL
  SELECT 'level_3', unnest(filters.level_3) FROM survey) GROUP BY level_name, v""")
def _(t):
    long = fl.unpivot_levels(t.survey).select("level_name", F.explode("level_value").alias("value"))
    return long.groupBy("level_name", "value").agg(F.count("*").alias("answers"))


@query("child_levels_of_parent", "F13", "filter_groups", """
SELECT DISTINCT level_3 FROM filter_groups WHERE level_1 = 'EUROPE' AND level_3 IS NOT NULL""")
def _(t):
    return fl.child_levels(t.filter_groups, "level_1", "EUROPE", "level_3")


@query("parts_matching_name_or_identifier", "F14", "", """
SELECT p_brand, count(*) AS n FROM part WHERE regexp_matches(lower(coalesce(p_name, '')), 'r(ed|ing)')
  OR regexp_matches(lower(coalesce(p_type, '')), '^promo') GROUP BY p_brand""")
def _(t):
    # The part catalogue stands in for the metric catalogue: a name and an identifier to search.
    kpis = t.part.withColumnsRenamed({"p_name": "kpi_name", "p_type": "kpi_identifier"})
    return fl.kpis_matching(kpis, "r(ed|ing)|^promo").groupBy("p_brand").agg(F.count("*").alias("n"))


@query("filter_rows_with_metric", "F15", "filter_values", """
SELECT 'with' AS side, filter_name, count(*) AS n FROM filter_values WHERE list_has_any(kpi_uuids, ['kpi-ctfc', 'kpi-tests']) GROUP BY filter_name
UNION ALL SELECT 'without', filter_name, count(*) FROM filter_values
WHERE NOT coalesce(list_has_any(kpi_uuids, ['kpi-ctfc', 'kpi-tests']), false) GROUP BY filter_name""")
def _(t):
    wanted = ["kpi-ctfc", "kpi-tests"]
    sides = [
        fl.with_kpis(t.filter_values, wanted, present=p).withColumn("side", F.lit(s)) for s, p in (("with", True), ("without", False))
    ]
    return sides[0].unionByName(sides[1]).groupBy("side", "filter_name").agg(F.count("*").alias("n"))


@query("web_scans_by_name_in_filter", "F16", "flat web_scans", """
SELECT WebsiteName, count(*) AS n FROM web_scans s WHERE EXISTS (SELECT 1 FROM flat f WHERE f.kpi = 'kpi-web'
  AND f.level_1 = 'AFRICA' AND list_contains(f.project_name, s.WebsiteName)) GROUP BY WebsiteName""")
def _(t):
    filt = flat(t, "project_name").filter(fl.in_scope("kpi-web", level_1="AFRICA"))
    return (
        fl.name_in_arrays(t.web_scans, filt, "WebsiteName", "project_name").groupBy("WebsiteName").agg(F.count("*").alias("n"))
    )


@query("secret_scans_by_tag", "F17", "secret_scans", """
SELECT repository, count(*) AS n FROM secret_scans
WHERE list_has_any(list_transform(tags, lambda x: concat(x.type, ':', x.value)), ['env:prod', 'repo:r3']) GROUP BY repository""")
def _(t):
    return fl.tag_filter(t.secret_scans, ["env:prod", "repo:r3"]).groupBy("repository").agg(F.count("*").alias("n"))


TAG_SQL = """SELECT repository, count(*) AS n FROM test_runs r WHERE EXISTS (SELECT 1 FROM ({0}) w
  WHERE w.tag = 'X' OR list_contains(r.pipeline_tags, w.tag)) GROUP BY repository"""


@query("test_runs_by_tag", "F18", "flat test_runs", TAG_SQL.format(
    "SELECT unnest(pipeline_tags) AS tag FROM flat WHERE kpi = 'kpi-tests' AND level_1 = 'AMERICA'"))
def _(t):
    wanted = fl.scope_values(rows(t), "pipeline_tags", "kpi-tests", level_1="AMERICA")
    return fl.tag_wildcard(t.test_runs, wanted).groupBy("repository").agg(F.count("*").alias("n"))


@query("test_runs_by_tag_wildcard", "F18", "flat test_runs", TAG_SQL.format(
    "SELECT coalesce(g, 'X') AS tag FROM flat LEFT JOIN unnest(pipeline_tags) AS x(g) ON true WHERE kpi = 'kpi-tests'"))
def _(t):
    tags = flat(t, "project_url", "pipeline_tags").filter(fl.in_scope("kpi-tests")).select(F.explode_outer("pipeline_tags").alias("tag"))
    tags = tags.select(F.coalesce("tag", F.lit("X")).alias("tag"))
    return fl.tag_wildcard(t.test_runs, tags).groupBy("repository").agg(F.count("*").alias("n"))


@query("language_names_of_tenant", "F19", "assist", """
SELECT DISTINCT language AS name FROM assist WHERE org_name = 'org-2' AND usage_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def _(t):
    usage = t.assist.select("org_name", "usage_date", F.lit("language").alias("param_name"), F.col("language").alias("parameter"))
    scope = (F.col("org_name") == "org-2") & F.col("usage_date").between(
        F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date")
    )
    return fl.scoped_names(usage, "language", scope)


@query("code_review_steps_of_tenant", "F20", "flow_steps", """
SELECT org_name, pipeline_step_conclusion, count(*) AS n FROM flow_steps WHERE org_name = 'org-3'
  AND (lower(pipeline_step_type) LIKE '%review%' OR lower(pipeline_step_name) LIKE '%review%')
GROUP BY org_name, pipeline_step_conclusion""")
def _(t):
    steps = fl.stage_filter(t.flow_steps, "code_review", F.col("org_name") == "org-3")
    return steps.groupBy("org_name", "pipeline_step_conclusion").agg(F.count("*").alias("n"))


@query("commits_with_fallback_scope", "F21", "commits", """
SELECT 'integration' AS scope, org_name, count(*) AS n FROM commits WHERE project_url IN
  ('https://git.example/n3', 'https://git.example/n4.git') GROUP BY org_name
UNION ALL SELECT 'tenant', org_name, count(*) FROM commits WHERE org_name = 'org-1' GROUP BY org_name""")
def _(t):
    urls = ["https://git.example/n3", "https://git.example/n4.git"]
    arms = [
        t.commits.filter(fl.fallback_scope(found, "org-1")).withColumn("scope", F.lit(name))
        for name, found in (("integration", urls), ("tenant", []))
    ]
    return arms[0].unionByName(arms[1]).groupBy("scope", "org_name").agg(F.count("*").alias("n"))


@query("commits_semi_joined_to_scope", "F22", "flat commits", """
SELECT project_url, count(*) AS n FROM commits WHERE project_url IN (SELECT unnest(project_url) FROM flat WHERE kpi = 'kpi-commits')
GROUP BY project_url""")
def _(t):
    scope = fl.scope_values(rows(t), "project_url", "kpi-commits")
    return fl.semi_scope(t.commits, scope, "project_url").groupBy("project_url").agg(F.count("*").alias("n"))


@query("rows_holding_value", "F23", "test_runs", """
SELECT repository, count(*) AS n FROM test_runs WHERE contains(pipeline_id, 'tag-5') OR contains(step_id, 'tag-5')
  OR contains(test_name, 'tag-5') OR contains(repository, 'tag-5') OR contains(git_url, 'tag-5')
  OR coalesce(list_contains(pipeline_tags, 'tag-5'), false) GROUP BY repository""")
def _(t):
    return fl.find_value(t.test_runs, "tag-5").groupBy("repository").agg(F.count("*").alias("n"))
