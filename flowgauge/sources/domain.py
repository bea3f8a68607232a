"""Domain frames derived from the parquet tables.

Each frame is a projection, or a small aggregate of one table, written once as SQL text. Spark runs it over DataFrames; the oracle uses the
same text, with the few spellings that differ swapped in, as a common table expression. Operators never appear here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass


class SparkText:
    """Spellings used by Spark SQL. Unknown attributes are table placeholders."""

    name = "spark"

    def __getattr__(self, table: str) -> str:
        if table.startswith("__"):
            raise AttributeError(table)
        return "{" + table + "}"

    def arr(self, *items: str) -> str:
        return f"array({', '.join(items)})"

    def rec(self, **fields: str) -> str:
        return f"named_struct({', '.join(f'{chr(39)}{k}{chr(39)}, {v}' for k, v in fields.items())})"

    def rows(self, array: str) -> str:
        return f"explode({array})"

    def json(self, **fields: str) -> str:
        return f"to_json({self.rec(**fields)})"

    def hours(self, ts: str, n: str) -> str:
        return f"({ts} + make_dt_interval(0, cast({n} AS int)))"

    def site_time(self, ts: str) -> str:
        return f"date_format({ts}, 'dd/MM/yyyy hh:mm a')"

    def iso_day(self, day: str) -> str:
        return f"date_format({day}, 'yyyy-MM-dd')"

    def iso_time(self, ts: str) -> str:
        return f"""date_format({ts}, "yyyy-MM-dd'T'HH:mm:ss")"""

    null_list = "cast(NULL AS array<string>)"


class DuckText(SparkText):
    name = "duckdb"

    def __getattr__(self, table: str) -> str:
        if table.startswith("__"):
            raise AttributeError(table)
        return table

    def arr(self, *items: str) -> str:
        return f"[{', '.join(items)}]"

    def rec(self, **fields: str) -> str:
        return f"struct_pack({', '.join(f'{k} := {v}' for k, v in fields.items())})"

    def rows(self, array: str) -> str:
        return f"unnest({array})"

    def json(self, **fields: str) -> str:
        return f"CAST(to_json({self.rec(**fields)}) AS VARCHAR)"

    def hours(self, ts: str, n: str) -> str:
        return f"({ts} + to_hours(cast({n} AS int)))"

    def site_time(self, ts: str) -> str:
        return f"strftime({ts}, '%d/%m/%Y %I:%M %p')"

    def iso_day(self, day: str) -> str:
        return f"strftime({day}, '%Y-%m-%d')"

    def iso_time(self, ts: str) -> str:
        return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"

    null_list = "cast(NULL AS varchar[])"


@dataclass(frozen=True)
class Frame:
    needs: tuple[str, ...]
    text: Callable[[SparkText], str]


FRAMES: dict[str, Frame] = {}


def frame(name: str, *needs: str):
    def add(fn: Callable[[SparkText], str]):
        FRAMES[name] = Frame(needs, fn)
        return fn

    return add


SEVERITY = (
    "CASE WHEN l_quantity > 45 THEN 'critical' WHEN l_quantity > 30 THEN 'high' "
    "WHEN l_quantity > 12 THEN 'medium' ELSE 'low' END"
)
SHA = "md5(concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string)))"
LINE_ID = "concat_ws('-', cast(l_orderkey AS string), cast(l_linenumber AS string), cast(l_partkey AS string), cast(l_suppkey AS string))"


# ---- filter hierarchy -------------------------------------------------------------------------------------------


@frame("filter_groups", "nation", "region")
def _(d):
    return f"""SELECT concat('fg-', n_nationkey) AS filter_group_id, r_name AS level_1,
        CASE WHEN n_nationkey % 4 = 0 THEN concat('off:', n_nationkey % 7) ELSE concat('unit-', n_nationkey % 7) END AS level_2,
        n_name AS level_3, concat('area-', n_nationkey % 3) AS level_4, cast(NULL AS string) AS level_5,
        n_nationkey % 25 <> 24 AS active
      FROM {d.nation} JOIN {d.region} ON n_regionkey = r_regionkey"""


@frame("filter_values", "nation")
def _(d):
    n = "n_nationkey"
    url = f"concat('https://git.example/n', {n}, CASE WHEN {n} % 3 = 0 THEN '.git' ELSE '' END)"
    tool = f"CASE {n} % 3 WHEN 0 THEN 'assistant-a' WHEN 1 THEN 'assistant-b' ELSE 'assistant-c' END"
    rows = [
        # filter name, tool type, values, metric ids, which nations have the row
        ("project_url", "'github'", d.arr(url), ("df", "ltfc", "commits", "tests"), "1 = 1"),
        ("deployment_stages", "'github'", d.arr("'release'", f"CASE WHEN {n} % 6 = 2 THEN 'build' ELSE 'deploy' END"), ("df", "ltfc"), "1 = 1"),
        ("pipeline_status_success", "'github'", d.arr("'success'"), ("df", "ltfc"), "1 = 1"),
        ("project_name", "'jira'", d.arr(f"concat('P', {n} % 10)"), ("ctfc", "cfr", "mttr"), f"{n} % 4 <> 3"),
        ("issue_status", "'jira'", d.arr("'Done'", "'Completed'"), ("ctfc",), f"{n} % 8 <> 5"),
        ("include_issue_types", "'jira'", d.arr("'Story'", "'Bug'"), ("ctfc",), f"{n} % 3 = 0"),
        ("include_issue_status", "'jira'", d.arr("'Done'", "'In Progress'"), ("ctfc",), f"{n} % 5 = 0"),
        ("exclude_issue_status", "'jira'", d.arr("'Cancelled'"), ("ctfc", "cfr"), f"{n} % 6 = 1"),
        ("board_ids", "'jira'", d.arr(f"cast({n} % 6 AS string)", f"cast({n} % 6 + 6 AS string)"), ("ctfc",), f"{n} % 2 = 0"),
        ("org_name", tool, d.arr(f"concat('org-', {n} % 6)"), ("assist",), f"{n} % 7 <> 6"),
        ("team_names", tool, d.arr(f"concat('team-', {n} % 3)"), ("assist",), f"{n} % 5 = 0"),
        ("pipeline_tags", "'github'", d.arr(f"concat('tag-', {n} % 9)", f"CASE WHEN {n} % 10 <> 5 THEN concat('tag-', {n} % 9) END"), ("tests",), f"{n} % 2 = 1"),
        ("project_name", "'scanner'", d.arr(f"concat('SVC-', {n})", f"concat('SVC-', {n} + 25)"), ("quality", "web"), "1 = 1"),
    ]
    entries = d.arr(
        *[
            d.rec(
                id=f"concat('fv-', {n}, '-{i}')", tool_type=tool_type, filter_name=f"'{name}'", filter_values=values,
                kpi_uuids=d.arr(*[f"'kpi-{k}'" for k in kpis]), listed=cond,
            )
            for i, (name, tool_type, values, kpis, cond) in enumerate(rows)
        ]
    )
    return f"""SELECT e.id AS id, filter_group_id, e.tool_type AS tool_type, e.filter_name AS filter_name,
        e.filter_values AS filter_values, e.kpi_uuids AS kpi_uuids, active
      FROM (SELECT concat('fg-', {n}) AS filter_group_id, {n} <> 23 AS active, {d.rows(entries)} AS e FROM {d.nation}) AS x
      WHERE e.listed"""


# ---- deployments, commits, issues ---------------------------------------------------------------------------------


@frame("deploys", "orders", "customer")
def _(d):
    return f"""SELECT o_orderkey AS run_id, 'github' AS pipeline_source,
        concat('https://git.example/n', c_nationkey, CASE WHEN o_orderkey % 2 = 0 THEN '.git' ELSE '' END) AS project_url,
        concat('P', c_nationkey % 10) AS project_name, concat('NATION_', c_nationkey) AS level,
        concat('team-', o_custkey % 3) AS team, concat('flow-', o_orderkey) AS pipeline_id,
        concat('flow-', o_orderkey % 50, '-main') AS pipeline_name,
        CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS pipeline_status,
        cast(o_orderkey AS string) AS step_id,
        CASE o_orderkey % 8 WHEN 0 THEN 'review' WHEN 1 THEN 'build' WHEN 2 THEN 'security' WHEN 3 THEN 'quality'
          WHEN 4 THEN 'test' WHEN 5 THEN 'production' ELSE 'deploy' END AS step_type,
        CASE WHEN o_orderkey % 9 = 8 THEN 'code-review' WHEN o_orderkey % 4 = 3 THEN 'build' ELSE 'deploy' END AS step_name,
        CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failure' END AS step_conclusion,
        o_orderdate AS pipeline_started_at,
        CASE WHEN o_orderstatus = 'F' THEN md5(cast(o_orderkey AS string)) END AS pipeline_commit_sha
      FROM {d.orders} JOIN {d.customer} ON o_custkey = c_custkey"""


@frame("deploy_commits", "lineitem")
def _(d):
    return f"""SELECT 'github' AS pipeline_source, md5(cast(l_orderkey AS string)) AS to_sha, {SHA} AS commit_id,
        l_shipdate AS committed_date, concat('dev', l_partkey % 150) AS commit_author,
        concat('https://git.example/n', l_suppkey % 25, '/commit/', {SHA}) AS web_url
      FROM {d.lineitem}"""


@frame("incidents", "orders")
def _(d):
    hours = "cast(floor(o_totalprice) AS bigint) % 400"
    return f"""SELECT concat('CHG-', o_orderkey) AS issue_key, concat('P', o_custkey % 10) AS issue_project,
        concat('NATION_', o_custkey % 25) AS level, concat('team-', o_custkey % 3) AS team, 'jira' AS itsm_source,
        CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'P' THEN 'Failed' ELSE 'Open' END AS issue_status,
        o_orderdate AS issue_created,
        CASE WHEN o_orderkey % 5 < 4 THEN {d.hours('o_orderdate', hours)} END AS issue_resolution_date,
        concat('CHG-', o_orderkey) AS cfr_total_changes_key,
        CASE WHEN o_orderstatus = 'P' THEN concat('CHG-', o_orderkey) END AS cfr_total_failures_key,
        CASE WHEN o_orderpriority = '1-URGENT' THEN concat('CHG-', o_orderkey) END AS mttr_issue_key
      FROM {d.orders}"""


ISSUE_BOARDS = lambda d, k: d.arr(
    d.rec(board_id=f"cast({k} % 12 AS bigint)", board_name=f"concat('board-', {k} % 12)", board_type="'scrum'"),
    d.rec(board_id="cast(99 AS bigint)", board_name="'portfolio'", board_type="'kanban'"),
)


@frame("issue_history", "lineitem", "orders")
def _(d):
    return f"""SELECT concat('ISS-', l_orderkey) AS issue_key, md5({LINE_ID}) AS change_id, 'jira' AS itsm_source,
        CASE l_partkey % 3 WHEN 0 THEN 'Story' WHEN 1 THEN 'Bug' ELSE 'Task' END AS issue_type,
        concat('P', o_custkey % 10) AS issue_project, concat('NATION_', o_custkey % 25) AS level,
        concat('team-', o_custkey % 3) AS team,
        CASE l_returnflag WHEN 'A' THEN 'Done' WHEN 'R' THEN 'Completed' ELSE 'In Progress' END AS issue_status,
        CASE WHEN l_linestatus = 'O' THEN 'status' WHEN l_partkey % 2 = 0 THEN 'Epic Status' ELSE 'assignee' END
          AS issue_changelog_itemsfield,
        CASE WHEN l_shipdate < o_orderdate THEN l_shipdate ELSE o_orderdate END AS issue_created, l_shipdate AS issue_updated,
        {ISSUE_BOARDS(d, 'l_suppkey')} AS board_info
      FROM {d.lineitem} JOIN {d.orders} ON l_orderkey = o_orderkey"""


@frame("issues", "orders")
def _(d):
    days = "24 * (o_custkey % 45)"
    return f"""SELECT concat('ISS-', o_orderkey) AS issue_key, 'jira' AS itsm_source, concat('org-', o_custkey % 6) AS customer_id,
        CASE o_orderkey % 3 WHEN 0 THEN 'Story' WHEN 1 THEN 'Bug' ELSE 'Task' END AS issue_type,
        concat('P', o_custkey % 10) AS issue_project,
        CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'P' THEN 'done' ELSE 'In Progress' END AS issue_status,
        o_orderpriority AS issue_priority, o_orderdate AS issue_created,
        CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 10 < 9 THEN {d.hours('o_orderdate', days)} END AS issue_resolution_date,
        cast(o_custkey % 20 AS int) AS sprint_id, concat('Sprint ', o_custkey % 20) AS sprint_name,
        CASE WHEN o_custkey % 20 < 15 THEN 'closed' ELSE 'active' END AS sprint_state,
        CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE cast(o_orderkey % 8 + 1 AS string) END AS story_points,
        {ISSUE_BOARDS(d, 'o_custkey')} AS board_info
      FROM {d.orders}"""


@frame("boards", "supplier")
def _(d):
    return f"""SELECT CASE WHEN s_acctbal >= 500 THEN s_suppkey ELSE s_suppkey + 1000000000 END AS board_id, concat('board-', s_suppkey) AS board_name, concat('org-', s_nationkey % 6) AS org_name
      FROM {d.supplier}"""


@frame("commits", "lineitem")
def _(d):
    url = "concat('https://git.example/n', l_suppkey % 25, CASE WHEN l_partkey % 2 = 0 THEN '.git' ELSE '' END)"
    add, gone = "cast(floor(l_quantity) AS int)", "cast(floor(l_discount * 100) AS int)"
    ext = "CASE l_partkey % 5 WHEN 0 THEN '.py' WHEN 1 THEN '.java' WHEN 2 THEN '.ts' WHEN 3 THEN '.sql' ELSE '.bin' END"

    def lines(a, r):
        return d.rec(additions=a, changes=f"{a} + {r}", deletions=r)

    files = d.arr(
        d.rec(file_extension=ext, lines=lines(add, gone)),
        d.rec(file_extension="'.md'", lines=lines("cast(l_linenumber AS int)", "cast(0 AS int)")),
    )
    return f"""SELECT {SHA} AS commit_id, cast(l_shipdate AS date) AS commit_date, l_shipdate AS commit_timestamp,
        concat('org-', l_suppkey % 6) AS org_name, concat('P', l_suppkey % 10) AS project_name, {url} AS project_url,
        cast(l_partkey % 150 AS int) AS user_id, CASE WHEN l_returnflag = 'A' THEN 'Y' END AS copilot_commit_flag,
        {add} AS lines_added, {gone} AS lines_removed,
        CASE WHEN l_linenumber % 5 = 0 THEN 'p1,p2' ELSE 'p1' END AS before_sha,
        {files} AS file_extension, concat({url}, '/commit/', {SHA}) AS web_url
      FROM {d.lineitem}"""


@frame("commits_prs", "lineitem", "orders")
def _(d):
    tools = (
        f"CASE l_suppkey % 4 WHEN 0 THEN {d.arr(chr(39) + 'assistant-a' + chr(39))} "
        f"WHEN 1 THEN {d.arr(chr(39) + 'assistant-b' + chr(39), chr(39) + 'assistant-a' + chr(39))} "
        f"WHEN 2 THEN {d.arr()} END"
    )
    tickets = f"CASE WHEN l_partkey % 3 = 0 THEN {d.null_list} ELSE {d.arr(chr(39) + 'none' + chr(39), 'concat(' + chr(39) + 'ISS-' + chr(39) + ', l_orderkey)')} END"
    return f"""SELECT {SHA} AS commit_id, l_shipdate AS commit_timestamp, concat('PR-', l_orderkey) AS pr_id,
        o_orderdate AS pr_created_datetime, md5(cast(l_orderkey AS string)) AS merge_commit_sha,
        {tickets} AS commit_tickets, {tools} AS ai_tool, concat('org-', l_suppkey % 6) AS org_name
      FROM {d.lineitem} JOIN {d.orders} ON l_orderkey = o_orderkey"""


@frame("pull_requests", "orders")
def _(d):
    def sha(i):
        return f"md5(concat(cast(o_orderkey AS string), '-{i}'))"

    def one(i):
        return d.rec(
            sha=sha(i),
            commit_timestamp=d.iso_time(d.hours("o_orderdate", f"-(o_custkey % 50) - {i}")),
            author_login=f"concat('dev', (o_custkey + {i}) % 150)",
            lines_added=f"cast((o_orderkey + {i}) % 90 AS string)",
            lines_removed=f"cast((o_orderkey + {i}) % 30 AS string)",
            copilot_commit_flag=f"CASE WHEN (o_orderkey + o_custkey * {i}) % 4 < 2 THEN 'Y' ELSE '' END",
        )

    return f"""SELECT concat('PR-', o_orderkey) AS merge_request_id, concat('org-', o_custkey % 6) AS org_name,
        concat('https://git.example/n', o_custkey % 25) AS project_url,
        CASE o_orderstatus WHEN 'F' THEN 'merged' WHEN 'P' THEN 'closed' ELSE 'open' END AS pr_state,
        o_orderstatus = 'F' AS merge_status, o_orderdate AS pr_created_datetime,
        CASE WHEN o_orderstatus = 'F' THEN {d.hours('o_orderdate', 'o_orderkey % 97 + 1')} END AS pr_merged_datetime,
        CASE WHEN o_orderkey % 6 <> 0 THEN {d.hours('o_orderdate', 'o_custkey % 31 + 1')} END
          AS first_pr_review_submitted_datetime,
        {sha(1)} AS first_commit_id,
        CASE o_orderkey % 4 WHEN 0 THEN {d.arr(one(1))} WHEN 1 THEN {d.arr(one(1), one(2))}
          WHEN 2 THEN {d.arr(one(1), one(2), one(3))} END AS pr_commits
      FROM {d.orders}"""


@frame("teams", "customer")
def _(d):
    return f"""SELECT concat('dev', c_custkey) AS assignee_login, concat('team-', c_custkey % 7) AS team_name,
        concat('org-', c_nationkey % 6) AS org_name,
        cast('2024-01-01' AS date) + cast(c_custkey % 5 * 7 - (c_nationkey % 6) AS int) AS record_update_date
      FROM {d.customer}"""


@frame("survey", "events")
def _(d):
    return f"""SELECT concat('survey-', cast(floor(day(ts) / 7) AS int)) AS survey_id, concat('q', event_id % 11) AS question_id,
        CASE WHEN event_id % 7 = 0 THEN 'Yes' WHEN event_id % 7 = 1 THEN 'No' WHEN event_id % 29 = 5 THEN 'skipped'
          ELSE cast(1 + event_id % 5 AS string) END AS answer,
        concat('resp-', user_id) AS response_id, ts AS last_submitted_timestamp,
        {d.rec(level_1=d.arr("concat('unit-', user_id % 7)"), level_2=d.null_list,
               level_3=d.arr("concat('NATION_', user_id % 25)"), level_4=d.null_list, level_5=d.null_list)} AS filters
      FROM {d.events}"""


@frame("change_requests", "orders")
def _(d):
    return f"""SELECT concat('CR-', o_orderkey) AS issue_key,
        CASE o_orderstatus WHEN 'F' THEN 'Done' WHEN 'P' THEN 'Failed' ELSE 'Open' END AS issue_status,
        o_orderdate AS issue_started_at,
        CASE WHEN o_orderstatus <> 'O' THEN {d.hours('o_orderdate', '24 * (o_custkey % 12)')} END AS issue_resolved_at,
        CASE WHEN o_custkey % 5 < 2 THEN concat('automated-deploy-', o_orderkey) WHEN o_custkey % 5 = 2 THEN 'manual' END
          AS correlation_id,
        concat('scope-', o_custkey % 4) AS scope, concat('class-', o_orderkey % 3) AS cr_class
      FROM {d.orders}"""


# ---- assistant usage ----------------------------------------------------------------------------------------------


@frame("assist", "events")
def _(d):
    gen = "cast(ceil(value) AS bigint)"
    acc = "cast(floor(value * (event_id % 10) / 10) AS bigint)"
    return f"""SELECT cast(ts AS date) AS usage_date, ts AS used_at, user_id, concat('dev', user_id) AS user_login,
        concat('org-', user_id % 6) AS org_name, concat('team-', user_id % 3) AS team_name,
        CASE event_id % 3 WHEN 0 THEN 'assistant-a' WHEN 1 THEN 'assistant-b' ELSE 'assistant-c' END AS tool,
        concat('ide-', user_id % 3) AS ide, concat('lang-', event_id % 5) AS language,
        concat('model-', event_id % 4) AS model, event_type AS feature,
        cast(1 AS bigint) AS user_initiated_interaction_count, {gen} AS code_generation_activity_count,
        {acc} AS code_acceptance_activity_count, {gen} * 3 AS loc_suggested_to_add_sum, {acc} * 2 AS loc_added_sum,
        {gen} AS loc_suggested_to_delete_sum, {acc} AS loc_deleted_sum,
        event_type = 'view' AS used_chat, event_type = 'purchase' AS used_agent
      FROM {d.events}"""


@frame("seats", "customer")
def _(d):
    return f"""SELECT concat('org-', c_nationkey % 6) AS org_name, concat(' Dev_', c_custkey, '@corp-', c_nationkey) AS org_assignee_login,
        concat('dev', c_custkey) AS assignee_login,
        CASE WHEN c_custkey % 4 <> 0
          THEN concat({d.iso_day("cast('2024-01-01' AS date) + cast(c_custkey % 30 AS int)")}, 'T0', c_custkey % 10, ':15:00') END
          AS last_activity_at,
        cast('2023-06-01' AS date) + cast(c_custkey % 200 AS int) AS created_at
      FROM {d.customer}"""


@frame("org_map", "nation")
def _(d):
    return f"""SELECT DISTINCT concat('org-', n_nationkey % 6) AS org_name,
        CASE WHEN n_nationkey % 6 = 5 THEN {d.arr()} WHEN n_nationkey % 6 = 1 THEN {d.arr("'org-1'", "'group-1'")}
          ELSE {d.arr("concat('org-', n_nationkey % 6)")} END AS linked_org_name
      FROM {d.nation}"""


# ---- quality and security -----------------------------------------------------------------------------------------


SCAN_KEY = """concat('org-', l_suppkey % 6) AS org_name, concat('svc-', l_partkey) AS project_name,
        CASE WHEN l_suppkey % 2 = 0 THEN 'main' ELSE 'develop' END AS branch"""


@frame("sonar_measures", "lineitem")
def _(d):
    return f"""SELECT org_name, project_name, branch, last_analysis_date, source_record_insert_datetime,
        cast(n AS bigint) AS project_bugs_value, cast(qty * 40 AS bigint) AS project_ncloc_value,
        cast(qty * 10 AS bigint) AS project_lines_to_cover_value, cast(qty * (n + key % 7) AS bigint) AS project_uncovered_lines_value,
        concat(cast(key % 5 + 1 AS string), '.0') AS project_reliability_rating_value,
        concat(cast(key % 3 + 1 AS string), '.0') AS project_security_rating_value,
        concat(cast(qty % 4 + 1 AS string), '.0') AS project_sqale_rating_value
      FROM (SELECT org_name, project_name, branch, cast(l_shipdate AS date) AS last_analysis_date,
          l_shipdate AS source_record_insert_datetime, count(*) AS n, cast(sum(cast(l_quantity AS int)) AS bigint) AS qty,
          max(l_orderkey) AS key
        FROM (SELECT {SCAN_KEY}, l_shipdate, l_quantity, l_orderkey FROM {d.lineitem}) AS s
        GROUP BY org_name, project_name, branch, l_shipdate) AS m"""


@frame("sonar_issues", "lineitem")
def _(d):
    return f"""SELECT {SCAN_KEY.replace('project_name', 'project')}, l_shipdate AS source_record_insert_datetime,
        CASE l_linenumber % 3 WHEN 0 THEN 'BUG' WHEN 1 THEN 'CODE_SMELL' ELSE 'VULNERABILITY' END AS type,
        {SEVERITY} AS severity,
        CASE WHEN l_returnflag = 'A' THEN 'OPEN' WHEN l_returnflag = 'R' THEN 'CLOSED'
          WHEN l_linestatus = 'O' THEN 'REOPENED' ELSE 'CONFIRMED' END AS status
      FROM {d.lineitem}"""


@frame("alerts", "lineitem")
def _(d):
    fixed = "24 * (l_partkey % 90)"
    return f"""SELECT md5({LINE_ID}) AS alert_id, concat('repo-', l_partkey % 100) AS repository_name,
        concat('org-', l_suppkey % 6) AS organization, {SEVERITY} AS severity, l_shipdate AS created_at,
        CASE WHEN l_returnflag = 'A' THEN {d.hours('l_shipdate', fixed)} END AS fixed_at,
        CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN {d.hours('l_shipdate', '48')} END AS dismissed_at
      FROM {d.lineitem}"""


@frame("container_scans", "lineitem")
def _(d):
    def cve(i, sev):
        return d.rec(identifier=f"concat('CVE-', (l_partkey * {i} + 7) % 997)", severity=sev)

    low, crit, top = cve(1, "'low'"), cve(3, "'Critical'"), cve(5, SEVERITY)
    return f"""SELECT concat('svc-', l_partkey % 50) AS project_name, concat('img-', l_suppkey % 400) AS unique_sha_id,
        md5({LINE_ID}) AS component_sha_id, {SEVERITY} AS severity, l_shipdate AS activity_date,
        CASE l_linenumber % 4 WHEN 0 THEN {d.arr(low)} WHEN 1 THEN {d.arr(low, top)} WHEN 2 THEN {d.arr(top, crit, top)} END AS cve
      FROM {d.lineitem}"""


@frame("web_scans", "orders")
def _(d):
    return f"""SELECT concat('w-', o_custkey) AS WebsiteId, concat('SVC-', o_custkey % 50) AS WebsiteName,
        concat('https://site', o_custkey, '.example') AS TargetUrl, concat('/run/', o_orderkey) AS TargetPath,
        CASE WHEN o_orderstatus = 'O' THEN 'Cancelled' ELSE 'Complete' END AS State, o_orderkey AS scan_id,
        o_orderdate AS InitiatedAt,
        CASE WHEN o_orderkey % 50 = 0 THEN 'not yet' ELSE {d.site_time(d.hours('o_orderdate', 'o_orderkey % 24'))} END AS InitiatedTime
      FROM {d.orders}"""


@frame("web_issues", "lineitem")
def _(d):
    return f"""SELECT concat('w-', l_partkey) AS WebsiteId, concat('finding ', l_linenumber) AS Title,
        CASE WHEN l_quantity > 40 THEN 'Critical' WHEN l_quantity > 20 THEN 'High' WHEN l_quantity > 10 THEN 'Information'
          ELSE 'BestPractice' END AS Severity,
        l_returnflag <> 'R' AS IsPresent, {d.site_time(d.hours('l_shipdate', 'l_orderkey % 24'))} AS LastSeenDate
      FROM {d.lineitem}"""


@frame("test_runs", "lineitem")
def _(d):
    total, failed = "cast(floor(l_quantity) AS int)", "cast(floor(l_discount * 50) AS int)"
    tag = "concat('tag-', l_partkey % 12)"
    return f"""SELECT concat('tp-', l_suppkey) AS pipeline_id, concat('step-', l_partkey % 40) AS step_id, l_linenumber AS run_count,
        concat('suite ', l_suppkey % 50) AS pipeline_name, concat('check ', l_partkey % 40) AS step_name,
        md5({LINE_ID}) AS test_name, concat('repo-', l_suppkey % 25) AS repository,
        CASE WHEN l_linenumber = 7 THEN '' ELSE concat('https://git.example/n', l_suppkey % 25) END AS git_url,
        {total} AS total_tests, {total} - least({failed}, {total}) AS passed_tests, least({failed}, {total}) AS failed_tests,
        cast(l_linenumber % 2 AS int) AS errored_tests, cast(l_partkey % 3 AS int) AS skipped_tests,
        CASE WHEN l_partkey % 4 = 3 THEN {d.null_list} ELSE {d.arr(tag, "'nightly'")} END AS pipeline_tags,
        CASE WHEN l_partkey % 100 <> 0 THEN l_shipdate END AS created_at
      FROM {d.lineitem}"""


@frame("secret_scans", "orders")
def _(d):
    return f"""SELECT concat('scan-', o_orderkey) AS scan_id, concat('repo-', o_custkey % 25) AS repository,
        concat('flow-', o_custkey % 4) AS flow_name, cast(o_orderkey % 7 AS int) AS total_issues, o_orderdate AS activity_date,
        {d.arr(d.rec(type="'repo'", value="concat('r', o_custkey % 25)"), d.rec(type="'env'", value="CASE WHEN o_orderkey % 2 = 0 THEN 'prod' ELSE 'dev' END"))} AS tags
      FROM {d.orders}"""


@frame("secret_issues", "lineitem")
def _(d):
    return f"""SELECT concat('scan-', l_orderkey) AS scan_id, {SEVERITY} AS severity, concat('reason-', l_linenumber % 3) AS reason
      FROM {d.lineitem}"""


@frame("test_tickets", "orders")
def _(d):
    def one(i):
        return d.rec(key=f"concat('T-', o_orderkey, '-{i}')", issue_type=f"CASE WHEN (o_custkey + {i}) % 3 = 0 THEN 'Bug' ELSE 'Test' END")

    return f"""SELECT concat('P', o_custkey % 10) AS project_name, concat('exec-', o_orderkey) AS execution_id,
        {d.rec(name="CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'P' THEN 'FAIL' ELSE 'TODO' END", final="o_orderstatus <> 'O'")} AS status,
        CASE o_orderkey % 3 WHEN 0 THEN {d.arr(one(1))} WHEN 1 THEN {d.arr(one(1), one(2))} END AS tickets
      FROM {d.orders}"""


# ---- flow, releases, telemetry ------------------------------------------------------------------------------------


@frame("flow_commits", "lineitem")
def _(d):
    return f"""SELECT concat('ISS-', l_orderkey) AS ticket_key, {SHA} AS commit_id, l_shipdate AS commit_timestamp,
        concat('dev', l_partkey % 150) AS commit_author, concat('change ', l_linenumber) AS commit_title,
        CASE WHEN l_returnflag = 'A' THEN 'Y' WHEN l_returnflag = 'R' THEN 'true' END AS copilot_commit_flag,
        cast(floor(l_quantity) AS bigint) AS commit_lines_added, cast(floor(l_discount * 100) AS bigint) AS commit_lines_removed,
        cast(l_partkey % 9 AS bigint) AS commit_lines_modified, concat('org-', l_suppkey % 6) AS org_name
      FROM {d.lineitem}"""


@frame("flow_prs", "orders")
def _(d):
    return f"""SELECT concat(CASE WHEN o_orderpriority = '5-LOW' THEN 'EXT-' ELSE 'ISS-' END, o_orderkey) AS ticket_key, concat('PR-', o_orderkey) AS pr_id,
        o_orderdate AS pr_created_datetime, concat('dev', o_custkey % 150) AS pr_user_name, 'update' AS pr_title,
        CASE o_orderstatus WHEN 'F' THEN 'merged' WHEN 'P' THEN 'closed' ELSE 'open' END AS pr_state,
        concat('org-', o_custkey % 6) AS org_name
      FROM {d.orders}"""


@frame("flow_steps", "orders")
def _(d):
    return f"""SELECT concat(CASE WHEN o_orderstatus = 'O' THEN 'EXT-' ELSE 'ISS-' END, o_orderkey) AS ticket_key, concat('flow-', o_orderkey) AS pipeline_id,
        {d.hours('o_orderdate', '5')} AS pipeline_started_at,
        concat('job ', o_orderkey % 11, CASE WHEN o_orderkey % 4 = 0 THEN ' Compile' WHEN o_orderkey % 13 = 1 THEN ' peer review' ELSE '' END) AS pipeline_step_name,
        CASE WHEN o_custkey % 5 = 0 THEN 'Security gate' WHEN o_custkey % 5 = 1 THEN 'load test' WHEN o_custkey % 5 = 2 THEN 'deploy'
          WHEN o_custkey % 20 = 3 THEN 'release train' WHEN o_custkey % 20 = 8 THEN 'quality' ELSE 'other' END AS pipeline_step_type,
        CASE WHEN o_orderstatus = 'P' THEN 'failure' ELSE 'success' END AS pipeline_step_conclusion,
        concat('org-', o_custkey % 6) AS org_name
      FROM {d.orders}"""


@frame("repo_runs", "orders", "customer")
def _(d):
    return f"""SELECT concat(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'other-' ELSE 'flow-' END, o_orderkey) AS pipeline_id, concat('P', c_nationkey % 10) AS project_name,
        concat('ISS-', o_orderkey) AS ticket_key, o_orderdate AS pipeline_started_at
      FROM {d.orders} JOIN {d.customer} ON o_custkey = c_custkey"""


@frame("job_logs", "documents")
def _(d):
    return f"""SELECT cast(doc_id AS string) AS job, text AS logs, lang FROM {d.documents}"""


@frame("releases", "orders")
def _(d):
    k, c = "o_orderkey", "o_custkey"
    at = lambda n: d.iso_time(d.hours("o_orderdate", n))
    day = lambda n: d.iso_day(f"(cast(o_orderdate AS date) + cast({n} AS int))")
    pick = lambda n, words: f"CASE {n} " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(words)) + " END"
    s = lambda x: f"cast({x} AS string)"

    issue = lambda i: d.json(
        issue_key=f"concat('ISS-', {k}, '-{i}')",
        issue_status=f"CASE WHEN ({k} + {i}) % 3 = 0 THEN 'In Progress' ELSE 'Done' END",
        is_done=f"CASE WHEN ({k} + {i}) % 3 = 0 THEN 'false' ELSE 'true' END",
        current_time=f"CASE WHEN ({k} + {i}) % 3 = 0 THEN NULL ELSE cast(3600 * (({c} * {i}) % 150 + 1) AS bigint) END",
    )
    defect = d.json(issue_key=f"concat('ISS-', {k}, '-1')", issue_type=pick(f"{k} % 2", ("Bug", "Story")),
                    isdefect=f"CASE WHEN {c} % 6 = 0 THEN 'true' ELSE 'false' END")
    deploy = lambda i: d.json(
        pipeline_id=f"concat('flow-', {k} % 50)", pipeline_group=pick(f"({k} + {i}) % 3", ("dev", "qa", "prod")),
        pipeline_status=f"CASE WHEN ({c} + {i}) % 5 = 0 THEN 'failed' ELSE 'success' END",
        pipeline_started_at=at(f"{c} % 9"), pipeline_finished_at=at(f"{c} % 9 + {i} + {k} % 4"),
        ltfc_seconds=f"cast(3600 + 60 * ({k} % 7000) AS bigint)",
    )
    pull = d.json(merge_request_id=s(k), pr_created_datetime=at("1"),
                  latest_pr_review_submitted_datetime=f"CASE WHEN {k} % 5 <> 0 THEN {at(f'2 + {c} % 70')} END",
                  pr_merged_datetime=f"CASE WHEN o_orderstatus = 'F' THEN {at(f'3 + {c} % 90')} END")
    build = d.json(build_id=s(k), build_status=pick(f"CASE WHEN {c} % 10 = 0 THEN 1 ELSE 0 END", ("success", "failed")),
                   tool_type=pick(f"{k} % 2", ("ci-a", "ci-b")))
    gate = d.json(step_id=s(k), step_status=pick(f"CASE WHEN {c} % 8 = 0 THEN 1 ELSE 0 END", ("success", "failed")),
                  tool_type=pick(f"{k} % 3", ("scanner", "linter", "ci-a")))
    vuln = d.json(unique_sha_id=f"concat('v-', {k})", activity_date=day("-20"),
                  last_activity_date=day(f"CASE WHEN {k} % 10 < 7 THEN -5 ELSE -20 END"))
    bug = d.json(key=f"concat('B-', {k})", status=f"CASE WHEN {k} % 5 < 3 THEN 'OPEN' ELSE 'CLOSED' END",
                 creation_date=day(f"-({c} % 20) - 5"), closed_date=f"CASE WHEN {k} % 5 >= 3 THEN {day('-1')} END")
    web = d.json(IssueId=f"concat('x-', {k})", IsPresent=f"CASE WHEN {k} % 3 = 0 THEN 'false' ELSE 'true' END",
                 IsAddressed=f"CASE WHEN {c} % 2 = 0 THEN 'true' ELSE 'false' END")
    passed = f"{k} % 90 + 30"
    tests = d.json(total_tests=s(f"{passed} + {k} % 7 + {c} % 5"), failed_tests=f"CASE WHEN {k} % 17 = 3 THEN 'unknown' ELSE {s(f'{k} % 7')} END",
                   skipped_tests=s(f"{c} % 5"), success_tests=s(passed))
    return f"""SELECT 'level_3' AS level_name, concat('NATION_', {c} % 25) AS level_value,
        concat('v', year(o_orderdate), '.', month(o_orderdate)) AS fix_version, concat('P', {c} % 10) AS issue_project,
        cast(o_orderdate AS date) + 10 AS release_date,
        CASE WHEN o_orderstatus = 'F' THEN 'released' ELSE 'unreleased' END AS release_status,
        {d.arr(issue(1), issue(2))} AS issues, {d.arr(defect)} AS defects, {d.arr(deploy(1), deploy(2))} AS deployments,
        {d.arr(pull)} AS pull_requests, {d.arr(build)} AS builds, {d.arr(gate)} AS gates, {d.arr(vuln)} AS vulnerabilities,
        CASE WHEN {k} % 4 <> 0 THEN {d.arr(bug)} END AS bugs, {d.arr(web)} AS web_vulnerabilities, {d.arr(tests)} AS tests
      FROM {d.orders}"""


@frame("instances", "supplier")
def _(d):
    return f"""SELECT concat('inst-', s_suppkey) AS instance_id, concat('env-', s_nationkey % 3) AS environment,
        concat('org-', s_nationkey % 6) AS org_name, cast(50 + s_suppkey % 40 AS int) AS max_slots,
        cast(s_suppkey % 50 AS int) AS reserved_slots FROM {d.supplier}"""


@frame("nodes", "lineitem")
def _(d):
    return f"""SELECT concat('inst-', l_suppkey) AS instance_id, concat('node-', l_suppkey, '-', l_linenumber) AS node_id,
        cast(16 + l_suppkey % 4 * 16 AS int) AS total_memory_gb, cast(l_linenumber + 3 AS int) AS jvm_max_mem_gb,
        cast(4 + l_partkey % 3 * 4 AS int) AS cpu_cores, l_shipdate AS create_time
      FROM {d.lineitem}"""


@frame("activities", "events")
def _(d):
    return f"""SELECT concat('dev', user_id) AS by_whom, event_type, ts AS create_time FROM {d.events}"""
