"""Registry of named queries: a Spark plan and, next to it, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from flowgauge.sources.domain import FRAMES, DuckText
from flowgauge.sources.frames import Tables


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    plan: Callable[..., DataFrame]
    sql: str | None
    job: Callable[[Tables], Any] | None = None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        """Run the job that writes, if the query has one, then plan what is read back. Planning itself writes nothing."""
        tables = Tables(spark, folder)
        return self.plan(tables) if self.job is None else self.plan(tables, self.job(tables))


QUERIES: dict[str, Query] = {}

# The filter hierarchy flattened in SQL, for the oracles of queries that resolve a scope.
_LIST = "list_sort(list_distinct(flatten(list(filter_values) FILTER (filter_name = '{0}'))))"
_FLAT_COLS = (
    "project_url", "project_name", "deployment_stages", "pipeline_status_success", "issue_status",
    "include_issue_types", "include_issue_status", "exclude_issue_status", "board_ids", "org_name", "team_names", "pipeline_tags",
)
FLAT = (
    "SELECT g.filter_group_id, level_1, level_2, level_3, level_4, level_5, tool_type, kpi, "
    + ", ".join(f"{_LIST.format(c)} AS {c}" for c in _FLAT_COLS)
    + " FROM filter_groups g JOIN (SELECT *, unnest(kpi_uuids) AS kpi FROM filter_values WHERE active) v"
    " ON g.filter_group_id = v.filter_group_id WHERE g.active"
    " GROUP BY g.filter_group_id, level_1, level_2, level_3, level_4, level_5, tool_type, kpi"
)
# The scope of delivery metrics: repositories with stages and statuses, and projects, by level.
DEPLOY_RULES = r"""SELECT DISTINCT kpi, level_3 AS level, regexp_replace(u, '\.git$', '') AS repo, s AS stage, st AS status
  FROM flat, unnest(project_url) a(u), unnest(deployment_stages) b(s), unnest(pipeline_status_success) c(st)"""
TICKET_RULES = "SELECT DISTINCT kpi, level_3 AS level, p AS project FROM flat, unnest(project_name) a(p)"
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "flat": (("filter_groups", "filter_values"), FLAT),
    "deploy_rules": (("flat",), DEPLOY_RULES),
    "ticket_rules": (("flat",), TICKET_RULES),
}


def with_frames(uses: str, body: str) -> str:
    """Prefix body with the common table expressions it uses, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order or (name not in FRAMES and name not in CTES):
            return
        for need in FRAMES[name].needs if name in FRAMES else CTES[name][0]:
            visit(need)
        order.append(name)

    for name in uses.split():
        visit(name)
    if not order:
        return body.strip()
    duck = DuckText()
    parts = [f"{n} AS ({FRAMES[n].text(duck) if n in FRAMES else CTES[n][1]})" for n in order]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def query(name: str, covers: str, uses: str = "", sql: str | None = None, job: Callable[[Tables], Any] | None = None):
    """Register a plan. ``covers`` lists the inventory rows it shows, ``uses`` the frames its SQL needs.

    ``job`` writes tables; what it returns is handed to the plan.
    """

    def add(plan: Callable[..., DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, tuple(covers.split()), plan, None if sql is None else with_frames(uses, sql), job)
        return plan

    return add


def rnd(expr: str, digits: int = 2) -> str:
    """SQL for a DOUBLE rounded half up on its decimal digits."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30, 10)), {digits}) AS DOUBLE)"


def secs(a: str, b: str) -> str:
    """SQL for the whole seconds from a to b."""
    return f"CAST(date_diff('second', {a}, {b}) AS BIGINT)"
