"""Queries over profiles, calendars and table jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowgauge.functions.columns import short_id
from flowgauge.operators import calendar as cl
from flowgauge.operators import delivery as dl
from flowgauge.operators import filters as fl
from flowgauge.operators import flow as fw
from flowgauge.operators import profile as pf
from flowgauge.operators import release as rl
from flowgauge.plans.registry import query, rnd
from flowgauge.plans.scope import CTFC_MATCH, ctfc_filters, flat, with_board_ids
from flowgauge.session import scratch_path
from flowgauge.sources import tables as tb
from flowgauge.sources.stores import RunTable, ScopedTable, export_snapshot

# ---- profiles ------------------------------------------------------------------------------------------------------

PROFILED = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts", "customer": None}


@query("table_profiles", "X1", "", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS n_rows, " + (f"min(CAST({d} AS DATE)) AS min_date, max(CAST({d} AS DATE)) AS max_date" if d else "NULL::DATE AS min_date, NULL::DATE AS max_date") + f" FROM {n}"
    for n, d in PROFILED.items()))
def _(t):
    return pf.profile_tables({n: (getattr(t, n), d) for n, d in PROFILED.items()})


@query("keys_in_two_tables", "X3", "", """
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'only_right' WHEN b.k IS NULL THEN 'only_left' ELSE 'shared' END AS side
FROM (SELECT DISTINCT o_orderkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT l_partkey * 3 AS k FROM lineitem) b ON a.k = b.k""")
def _(t):
    return pf.set_diff(t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select((F.col("l_partkey") * 3).alias("k")), ["k"])


NULLABLE = ("project_url", "pipeline_status", "step_conclusion", "pipeline_commit_sha")


@query("null_rates", "X4", "deploys", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, {rnd(f'(count(*) - count({c})) * 100.0 / count(*)', 1)} AS null_percent FROM deploys" for c in NULLABLE))
def _(t):
    return pf.null_rates(t.deploys, NULLABLE)


@query("top_values", "X5", "commits", "SELECT user_id, count(*) AS n FROM commits GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20")
def _(t):
    return pf.top_values(t.commits, "user_id", 20)


@query("cross_tab", "X6", "sonar_issues", "SELECT type, severity, count(*) AS n FROM sonar_issues GROUP BY type, severity")
def _(t):
    return pf.cross_tab(t.sonar_issues, "type", "severity")


@query("non_null_counts", "X7", "pull_requests", """
SELECT org_name, count(*) AS n_rows, count(pr_merged_datetime) AS with_pr_merged_datetime,
  count(first_pr_review_submitted_datetime) AS with_first_pr_review_submitted_datetime, count(pr_commits) AS with_pr_commits FROM pull_requests GROUP BY org_name""")
def _(t):
    return pf.non_null_counts(t.pull_requests, ["pr_merged_datetime", "first_pr_review_submitted_datetime", "pr_commits"], ["org_name"])


@query("duplicate_commit_ids", "X8", "commits", """
SELECT commit_id, web_url, count(*) OVER (PARTITION BY commit_id) AS n_members FROM commits QUALIFY n_members > 1""")
def _(t):
    return pf.duplicates(t.commits, ["commit_id"], "web_url")


@query("rows_matching_pattern", "X9", "test_runs", """
SELECT repository, count(*) AS n FROM test_runs WHERE regexp_matches(concat_ws(' ', pipeline_id, step_id), 'tp-1[0-9] step-3')
  OR len(list_filter(coalesce(pipeline_tags, []), lambda x: regexp_matches(x, '^tag-1[01]$'))) > 0 GROUP BY repository""")
def _(t):
    hit = pf.matches("tp-1[0-9] step-3", ["pipeline_id", "step_id"]) | pf.matches("^tag-1[01]$", array="pipeline_tags")
    return t.test_runs.filter(hit).groupBy("repository").agg(F.count("*").alias("n"))


STATUS = "lower(issue_changelog_itemsfield) IN ('status', 'epic status')"
IN_YEAR = "CAST(issue_updated AS DATE) BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'"


@query("cycle_time_funnel", "X10", "flat issue_history", f"""
SELECT 0 AS position, 'source' AS stage, count(*) AS n_rows FROM issue_history UNION ALL
SELECT 1, 'status_changes', count(*) FROM issue_history WHERE {STATUS} UNION ALL
SELECT 2, 'in_window', count(*) FROM issue_history WHERE {STATUS} AND {IN_YEAR} UNION ALL
SELECT 3, 'matched', count(*) FROM issue_history s WHERE {STATUS} AND {IN_YEAR} AND {CTFC_MATCH} UNION ALL
SELECT 4, 'issues', count(DISTINCT issue_key) FROM issue_history s WHERE {STATUS} AND {IN_YEAR} AND {CTFC_MATCH}""")
def _(t):
    source = t.issue_history
    changed = F.lower("issue_changelog_itemsfield").isin("status", "epic status")
    in_year = F.to_date("issue_updated").between(F.lit("1999-01-01").cast("date"), F.lit("1999-12-31").cast("date"))
    read = pf.stage_funnel(source, [("source", F.count("*")), ("status_changes", F.count_if(changed)), ("in_window", F.count_if(changed & in_year))])
    matched = fl.array_filter_join(with_board_ids(source.filter(changed & in_year)), ctfc_filters(t))
    kept = pf.stage_funnel(matched, [("matched", F.count("*")), ("issues", F.count_distinct("issue_key"))])
    return read.unionByName(kept.withColumn("position", F.col("position") + 3))


RANGES = {"1998": ("1998-01-01", "1998-12-31"), "1999_q1": ("1999-01-01", "1999-03-31"), "2010": ("2010-01-01", "2010-12-31")}
# The conditions read the same in both engines.
FILTERS = {"all": "true", "open": "state = 'open'", "critical_open": "state = 'open' AND severity = 'critical'"}
ALERT_STATE = "CASE WHEN fixed_at IS NOT NULL THEN 'fixed' WHEN dismissed_at IS NOT NULL THEN 'dismissed' ELSE 'open' END AS state"


@query("parameter_matrix", "X11", "alerts", f"WITH a AS (SELECT *, CAST(created_at AS DATE) AS day, {ALERT_STATE} FROM alerts) " + " UNION ALL ".join(
    f"SELECT '{r}' AS date_range, '{f}' AS filter, count(*) AS total FROM a WHERE day BETWEEN DATE '{a}' AND DATE '{b}' AND {cond}"
    for r, (a, b) in RANGES.items() for f, cond in FILTERS.items()))
def _(t):
    from flowgauge.operators.quality import alert_state

    daily = t.alerts.groupBy(F.to_date("created_at").alias("day"), alert_state().alias("state"), "severity").agg(F.count("*").alias("n"))
    return pf.combo_matrix(daily, "day", "n", RANGES, {f: F.expr(c) for f, c in FILTERS.items()})


TOKEN = "[A-Za-z0-9_.]+@[a-z0-9.]+[.][a-z]+"


@query("tokens_in_documents", "X12", "", f"""
SELECT DISTINCT 'text' AS column_name, unnest(regexp_extract_all(text, '{TOKEN}')) AS token FROM documents UNION
SELECT DISTINCT 'source', unnest(regexp_extract_all(source, '{TOKEN}')) FROM documents""")
def _(t):
    return pf.extract_tokens(t.documents, ["text", "source"], TOKEN)


@query("tokens_in_pages", "X12", "", """
SELECT DISTINCT 'html' AS column_name, unnest(regexp_extract_all(html, '/[a-z]{2}/[0-9]+')) AS token FROM pages UNION
SELECT DISTINCT 'url', unnest(regexp_extract_all(url, '/[a-z]{2}/[0-9]+')) FROM pages""")
def _(t):
    return pf.extract_tokens(t.pages, ["html", "url"], "/[a-z]{2}/[0-9]+")


@query("wired_project_urls", "X13", "flat deploys", """
SELECT DISTINCT project_url, project_url IN (SELECT unnest(project_url) FROM flat) AS is_wired FROM deploys""")
def _(t):
    return pf.wired(t.deploys, flat(t, "project_url").select(F.explode("project_url").alias("project_url")), "project_url")


@query("join_match_count", "X14", "deploys deploy_commits", """
SELECT count(DISTINCT pipeline_commit_sha) AS matching_keys, count(*) AS matching_pairs FROM deploys JOIN deploy_commits ON pipeline_commit_sha = to_sha""")
def _(t):
    return pf.join_matches(t.deploys, t.deploy_commits, "pipeline_commit_sha", "to_sha")


@query("first_rows_by_order", "X15", "deploys", """
SELECT run_id, project_url, pipeline_started_at FROM deploys ORDER BY pipeline_started_at DESC, run_id LIMIT 25""")
def _(t):
    rows = t.deploys.select("run_id", "project_url", "pipeline_started_at")
    return pf.first_rows(rows, 25, F.desc("pipeline_started_at"), "run_id")


@query("statuses_in_use", "X16", "deploys", "SELECT DISTINCT pipeline_status FROM deploys")
def _(t):
    return pf.enumeration(t.deploys, "pipeline_status")


@query("language_fill_rate", "X17", "assist", "SELECT language, count(*) AS n_rows, count(DISTINCT org_name) AS n_tenants FROM assist GROUP BY language")
def _(t):
    return pf.fill_rate(t.assist, "org_name", ["language"])


# ---- calendar ------------------------------------------------------------------------------------------------------

HOLIDAYS = tuple(f"{y}-{md}" for y in range(1995, 2002) for md in ("01-01", "07-04", "12-25"))
SHUTDOWNS = (("1997-12-24", "1998-01-02"), ("1999-12-24", "2000-01-02"))
SPINE = "(SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS day FROM orders)"


@query("orders_per_day_zero_filled", "K1", "", f"""
SELECT day, count(o_orderkey) AS n FROM {SPINE} LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY day""")
def _(t):
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    return cl.spine_of(t.orders, "o_orderdate").join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("orders_by_day_type", "K2", "", f"""
SELECT CASE {' '.join(f"WHEN d BETWEEN DATE '{a}' AND DATE '{b}' THEN 'shutdown'" for a, b in SHUTDOWNS)}
  WHEN d IN ({', '.join(f"DATE '{h}'" for h in HOLIDAYS)}) THEN 'holiday' WHEN isodow(d) > 5 THEN 'weekend' ELSE 'normal' END AS day_type,
  count(*) AS n FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) GROUP BY day_type""")
def _(t):
    return t.orders.groupBy(cl.day_type("o_orderdate", HOLIDAYS, SHUTDOWNS).alias("day_type")).agg(F.count("*").alias("n"))


WINDOWS = {"quarter_before": (92, 1), "three_days_around": (1, -1), "month_after": (-1, -30)}
ANCHOR = "1997-09-16"


def window_sql(c, w):
    return f"{c} BETWEEN DATE '{ANCHOR}' - {w[0]} AND DATE '{ANCHOR}' - {w[1]}"


@query("orders_in_event_windows", "K3", "", " UNION ALL ".join(
    f"SELECT '{n}' AS window_name, count(*) AS n FROM orders WHERE {window_sql('CAST(o_orderdate AS DATE)', w)}" for n, w in WINDOWS.items()))
def _(t):
    return cl.tag_windows(t.orders, "o_orderdate", WINDOWS, ANCHOR).groupBy("window_name").agg(F.count("*").alias("n"))


@query("business_day_picks", "K7", "", f"""
WITH b AS (SELECT day, CAST(date_trunc('month', day) AS DATE) AS month FROM {SPINE} WHERE isodow(day) < 6),
r AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY day) - 1 AS i, count(*) OVER (PARTITION BY month) AS business_days FROM b)
SELECT day, month, business_days, EXISTS (SELECT 1 FROM range(0, least(8, business_days)) g(j) WHERE (j * business_days) // least(8, business_days) = i) AS picked FROM r""")
def _(t):
    return cl.business_day_picks(cl.spine_of(t.orders, "o_orderdate"), 8)


@query("week_days_of_orders", "K8", "", """
SELECT monday, friday, weekday_before, count(*) AS n FROM (SELECT CAST(date_trunc('week', d) AS DATE) AS monday, CAST(date_trunc('week', d) AS DATE) + 4 AS friday,
  CASE isodow(d) WHEN 1 THEN d - 3 WHEN 7 THEN d - 2 ELSE d - 1 END AS weekday_before FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)) GROUP BY monday, friday, weekday_before""")
def _(t):
    return t.orders.groupBy(
        cl.week_day("o_orderdate", 0).alias("monday"), cl.week_day("o_orderdate", 4).alias("friday"),
        cl.last_weekday_before("o_orderdate").alias("weekday_before"),
    ).agg(F.count("*").alias("n"))


@query("sprints_with_issue_counts", "K9", "", """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
f AS (SELECT lo + CAST((8 - isodow(lo)) % 7 AS INTEGER) AS first, hi FROM b),
s AS (SELECT CAST(unnest(generate_series(first, hi - 1, INTERVAL 14 DAY)) AS DATE) AS sprint_start, first, hi FROM f)
SELECT CAST(date_diff('day', first, sprint_start) // 14 + 1 AS INTEGER) AS sprint_number, sprint_start, least(sprint_start + 13, hi) AS sprint_end,
  CASE WHEN least(sprint_start + 13, hi) < DATE '2000-06-01' THEN 'closed' ELSE 'active' END AS sprint_state,
  (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN sprint_start AND least(sprint_start + 13, hi)) AS issues FROM s""")
def _(t):
    bounds = t.orders.agg(F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    sprints = cl.sprint_windows(bounds, "2000-06-01")
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    # Each sprint lists its own days, so the counts are joined on equality.
    days = sprints.withColumn("day", F.explode(F.sequence("sprint_start", "sprint_end")))
    return days.join(daily, "day", "left").groupBy(*sprints.columns).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("issues"))


@query("months_with_orders", "K13", "", """
WITH m AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS DATE) AS month FROM orders)
SELECT month, CAST(year(month) * 100 + month(month) AS INTEGER) AS year_month, strftime(month, '%b %Y') AS month_name,
  (SELECT count(*) FROM orders WHERE CAST(date_trunc('month', o_orderdate) AS DATE) = m.month) AS n FROM m""")
def _(t):
    counts = t.orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("month")).agg(F.count("*").alias("n"))
    return cl.month_list(t.orders, "o_orderdate").join(counts, "month", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("short_run_ids", "K14", "", "SELECT o_orderkey, substr(sha1(concat_ws('|', o_orderkey, o_custkey)), 1, 12) AS run_id FROM orders")
def _(t):
    return t.orders.select("o_orderkey", short_id(12, "o_orderkey", "o_custkey").alias("run_id"))


# ---- table jobs ----------------------------------------------------------------------------------------------------


@query("table_read_whole_and_peek", "S1", "", """
SELECT 'whole' AS read, count(*) AS n FROM orders UNION ALL SELECT 'peek', count(*) FROM (SELECT * FROM orders LIMIT 100)""")
def _(t):
    reads = {"whole": tb.read_table(t.spark, t.folder, "orders"), "peek": tb.read_table(t.spark, t.folder, "orders", 100)}
    return pf.stack_frames([df.agg(F.count("*").alias("n")).withColumn("read", F.lit(name)) for name, df in reads.items()])


def appended(t):
    """Two runs, the first of them repeated: the repeat adds nothing."""
    table = RunTable(t.spark, scratch_path(t.spark, "orders"), "o_orderkey BIGINT, o_orderstatus STRING")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    for run in ("first", "second", "first"):
        table.append(rows, run)
    return table


@query("table_append", "S4", "", "SELECT o_orderstatus, run, count(*) AS n FROM orders, (VALUES ('first'), ('second')) r(run) GROUP BY o_orderstatus, run", appended)
def _(t, table):
    return table.read().groupBy("o_orderstatus", "run").agg(F.count("*").alias("n"))


@query("table_insert_missing", "S5", "", """
SELECT c_mktsegment, count(*) AS n, count(*) FILTER (c_mktsegment = 'NEW') AS inserted FROM (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer) GROUP BY c_mktsegment""")
def _(t):
    rows = t.customer.select("c_custkey", "c_mktsegment")
    target = rows.filter(F.col("c_mktsegment") != "BUILDING")
    merged = tb.insert_missing(target, rows.withColumn("c_mktsegment", F.lit("NEW")), ["c_custkey"])
    return merged.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_if(F.col("c_mktsegment") == "NEW").alias("inserted"))


DEPLOY_COLUMNS = "run_id BIGINT, pipeline_source STRING, step_conclusion STRING, level STRING"


def stored_deploys(t):
    rows = t.deploys.select("run_id", "pipeline_source", "step_conclusion", "level")
    return ScopedTable(t.spark, scratch_path(t.spark, "deploys"), DEPLOY_COLUMNS, ("level",)).create(rows)


FAILED_OF_TWO_SQL = "(level IN ('NATION_1', 'NATION_2') AND step_conclusion IS NOT DISTINCT FROM 'failure')"


def delete_failed(t):
    table = stored_deploys(t)
    failed_of_two = F.col("level").isin("NATION_1", "NATION_2") & (F.col("step_conclusion") == "failure")
    return table, table.delete(failed_of_two), table.delete(failed_of_two)


@query("table_scoped_delete_counts", "S6", "deploys", f"""
SELECT 'first' AS run, count(*) FILTER {FAILED_OF_TWO_SQL} AS deleted, count(*) FILTER (NOT {FAILED_OF_TWO_SQL}) AS remaining FROM deploys
UNION ALL SELECT 'repeated', 0, count(*) FROM deploys WHERE NOT {FAILED_OF_TWO_SQL}""", delete_failed)
def _(t, done):
    table, *changes = done
    now = table.read().agg(F.count("*").alias("remaining"))  # what stands in the files
    rows = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(c.deleted).cast("long").alias("deleted")) for r, c in zip(("first", "repeated"), changes, strict=True)])
    return now.select(F.inline(rows), "remaining")


@query("table_after_scoped_delete", "S6", "deploys", f"""
SELECT level, count(*) AS n FROM deploys WHERE NOT {FAILED_OF_TWO_SQL} GROUP BY level""", delete_failed)
def _(t, done):
    return done[0].read().groupBy("level").agg(F.count("*").alias("n"))


def reseed_twice(t):
    table = stored_deploys(t)
    scope = F.col("level") == "NATION_4"
    new = t.deploys.select("run_id", F.lit("reseeded").alias("pipeline_source"), "step_conclusion", "level").filter(scope)
    for _ in range(2):
        table.replace(scope, new)
    return table


@query("table_replace_scope_twice", "S7", "deploys", """
SELECT level, count(*) AS n, count(*) FILTER (pipeline_source = 'reseeded') AS reseeded FROM (SELECT level, pipeline_source FROM deploys WHERE level <> 'NATION_4'
  UNION ALL SELECT level, 'reseeded' FROM deploys WHERE level = 'NATION_4') GROUP BY level""", reseed_twice)
def _(t, table):
    return table.read().groupBy("level").agg(F.count("*").alias("n"), F.count_if(F.col("pipeline_source") == "reseeded").alias("reseeded"))


def delete_own(t):
    """Two owners share organisation and tool folders; one takes its rows out."""
    table = ScopedTable(t.spark, scratch_path(t.spark, "assist"), "usage_date DATE, loc_added_sum BIGINT, org_name STRING, tool STRING", ("org_name", "tool"))
    table.create(t.assist.select("usage_date", F.col("loc_added_sum").cast("long").alias("loc_added_sum"), "org_name", "tool"))
    table.delete(tb.owned_by("org-2", ["assistant-a", "assistant-c"]))
    return table


@query("table_shared_owner_delete", "S8", "assist", """
SELECT org_name, tool, count(*) AS n, CAST(sum(loc_added_sum) AS BIGINT) AS added FROM assist WHERE NOT (org_name = 'org-2' AND tool IN ('assistant-a', 'assistant-c')) GROUP BY org_name, tool""", delete_own)
def _(t, table):
    return table.read().groupBy("org_name", "tool").agg(F.count("*").alias("n"), F.sum("loc_added_sum").alias("added"))


def archive_old(t):
    """Old releases change their status, which is also the folder they lie in."""
    table = ScopedTable(t.spark, scratch_path(t.spark, "releases"), "release_date DATE, release_status STRING", ("release_status",))
    table.create(t.releases.select("release_date", "release_status"))
    first = F.lit("1997-01-01").cast("date")
    table.update(F.col("release_date") < first, {"release_status": F.lit("archived"), "release_date": first})
    return table


@query("table_update_where", "S9", "releases", """
SELECT release_status, count(*) AS n, min(release_date) AS first_date FROM (SELECT CASE WHEN release_date < DATE '1997-01-01' THEN 'archived' ELSE release_status END AS release_status,
  CASE WHEN release_date < DATE '1997-01-01' THEN DATE '1997-01-01' ELSE release_date END AS release_date FROM releases) GROUP BY release_status""", archive_old)
def _(t, table):
    return table.read().groupBy("release_status").agg(F.count("*").alias("n"), F.min("release_date").alias("first_date"))


@query("table_add_columns", "S10", "releases", """
SELECT fix_version, count(*) AS n, count(NULL::VARCHAR) AS with_level_2, count(level_name) AS with_level_name FROM releases GROUP BY fix_version""")
def _(t):
    rows = tb.add_columns(t.releases, {"level_2": "string", "sprint_id": "int", "level_name": "string"})
    return rows.groupBy("fix_version").agg(
        F.count("*").alias("n"), F.count("level_2").alias("with_level_2"), F.count("level_name").alias("with_level_name")
    )


COUNTED = ("orders", "lineitem", "events", "documents", "pages", "conversations", "labels")


@query("table_preview_counts", "S12", "", " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS n_rows FROM {n}" for n in COUNTED))
def _(t):
    return tb.preview_counts({n: getattr(t, n) for n in COUNTED})


def exported(t):
    path = scratch_path(t.spark, "deploys")
    rows = t.deploys.select("run_id", "pipeline_status", "level")
    return path, export_snapshot(rows, path, "level"), export_snapshot(rows, path, "level")


@query("table_export_and_restore", "S13", "deploys", "SELECT level, pipeline_status, count(*) AS n FROM deploys WHERE level IN ('NATION_5', 'NATION_6') GROUP BY level, pipeline_status", exported)
def _(t, done):
    back = tb.restore_scope(t.spark, done[0], "run_id BIGINT, pipeline_status STRING, level STRING", "level", ["NATION_5", "NATION_6"])
    return back.groupBy("level", "pipeline_status").agg(F.count("*").alias("n"))


@query("seats_view", "S14", "seats org_map", """
SELECT TRY_CAST(last_activity_at AS TIMESTAMP) AS usage_datetime, CAST(TRY_CAST(last_activity_at AS TIMESTAMP) AS DATE) AS usage_date,
  CAST(hour(TRY_CAST(last_activity_at AS TIMESTAMP)) AS INTEGER) AS usage_hour, o AS org_name, org_assignee_login,
  CASE WHEN o = 'group-1' THEN regexp_replace(trim(lower(org_assignee_login)), 'corp|_|-|@', '', 'g') ELSE org_assignee_login END AS cleansed_org_assignee_login,
  CASE WHEN o = 'group-1' THEN org_assignee_login ELSE assignee_login END AS cleansed_assignee_login, created_at
FROM seats JOIN (SELECT org_name AS base, unnest(linked_org_name) AS o FROM org_map) ON base = org_name""")
def _(t):
    return tb.seats_view(t.seats, t.org_map, ["group-1"])


@query("json_packed_and_unpacked", "S15 R1", "issues", """
SELECT issue_project, issue_key, issue_status, sprint_id FROM issues""")
def _(t):
    packed = tb.pack_json(t.issues, ["issue_project"], ["issue_key", "issue_status", "sprint_id"], "issues", per_row=500)
    return rl.unpack(packed, "issues", ["issue_project"], "issue_key STRING, issue_status STRING, sprint_id INT")
