"""Semantic filter layer: from the filter hierarchy to the rows of a fact.

Filter relations come from configuration, but no operator assumes they are small: joins are equi joins without broadcast
hints, so that Spark picks the strategy from measured sizes and can split skewed keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import all_of, any_of, col, git_url_key, like_any
from flowgauge.schemas import FILTER_NAMES, LEVELS

ANY = "x"


def filter_rows(groups: DataFrame, values: DataFrame) -> DataFrame:
    """Active groups joined to their active values: one row per group, filter name and metric id."""
    rows = values.filter("active").select(
        "filter_group_id", "tool_type", "filter_name", "filter_values", F.explode("kpi_uuids").alias("kpi")
    )
    return rows.join(groups.filter("active").select("filter_group_id", *LEVELS), "filter_group_id")


def flatten_filters(groups: DataFrame, values: DataFrame, names: Sequence[str] = FILTER_NAMES) -> DataFrame:
    """One row per group, tool type and metric id, with one array column per filter name.

    A filter that is not set stays NULL, which later means "no restriction"; one set to an empty list allows nothing.
    Arrays hold what the configuration lists
    for one group and metric; where only the values of one filter are needed, ``scope_values`` builds no arrays.
    """

    def values_of(name: str) -> Column:
        found = F.flatten(F.collect_list(F.when(F.col("filter_name") == name, F.col("filter_values"))))
        tidy = F.array_sort(F.array_distinct(found))
        return F.when(F.count_if((F.col("filter_name") == name) & F.col("filter_values").isNotNull()) > 0, tidy).alias(name)

    wanted = filter_rows(groups, values).filter(F.col("filter_name").isin(list(names)))
    return wanted.groupBy("filter_group_id", *LEVELS, "tool_type", "kpi").agg(*[values_of(n) for n in names])


def in_scope(kpi: str | None = None, **levels: str | Sequence[str]) -> Column:
    """Predicate on filter rows or flattened filters: one metric id and the wanted level values."""
    parts = [F.col("kpi") == kpi] if kpi else []
    for level, wanted in levels.items():
        parts.append(F.col(level).isin([wanted] if isinstance(wanted, str) else list(wanted)))
    return all_of(parts) if parts else F.lit(True)


def scope_values(rows: DataFrame, name: str, kpi: str, **levels: str | Sequence[str]) -> DataFrame:
    """Distinct values of one filter in scope, from filter rows. NULL and empty arrays give no rows."""
    named = rows.filter((F.col("filter_name") == name) & in_scope(kpi, **levels))
    return named.select(F.explode("filter_values").alias(name)).distinct()


def scope_values_outer(flat: DataFrame, columns: Sequence[str], kpi: str, **levels: str | Sequence[str]) -> DataFrame:
    """Distinct combinations of several filters in scope; a filter that is not set becomes the sentinel ``'x'``."""
    out = flat.filter(in_scope(kpi, **levels))
    for c in columns:
        out = out.withColumn(c, F.explode_outer(c))
    return out.select("tool_type", *[F.coalesce(c, F.lit(ANY)).alias(c) for c in columns]).distinct()


def wildcard_join(
    fact: DataFrame,
    filt: DataFrame,
    tool: str = "tool",
    level: str = "level",
    level_name: str = "level_name",
) -> DataFrame:
    """Fact rows by the team filter if it is set, else by the organisation filter; organisation ``'x'`` means any.

    ``filt`` has tool_type, org_name, team_names with ``'x'`` for "not set". The OR condition becomes one equi join: each
    filter row has a single target, and an organisation row of the fact is looked up under its own name and under ``'x'``.
    """
    team_set = F.col("team_names") != ANY
    target = filt.select(
        F.col("tool_type").alias("_tool"),
        F.when(team_set, F.lit("team")).otherwise(F.lit("organization")).alias("_level"),
        F.when(team_set, F.col("team_names")).otherwise(F.col("org_name")).alias("_name"),
        team_set.alias("_team_set"),
    )
    # A team literally named 'x' cannot be asked for: the sentinel always means "not set".
    lookups = F.when(F.col(level) == "organization", F.array_distinct(F.array(F.col(level_name), F.lit(ANY)))).otherwise(
        F.array(F.col(level_name))
    )
    keyed = fact.withColumn("_key", F.explode(lookups))
    return keyed.join(
        target,
        (keyed[tool] == target["_tool"]) & (keyed[level] == target["_level"]) & (keyed["_key"] == target["_name"]),
    ).drop("_key", "_tool", "_level", "_name", "_team_set")


def strict_join(
    fact: DataFrame, filt: DataFrame, tool: str = "tool", level: str = "level", level_name: str = "level_name"
) -> DataFrame:
    """Organisation rows whose name equals the filter's organisation. There is no wildcard."""
    target = filt.select(F.col("tool_type").alias("_tool"), F.col("org_name").alias("_org"))
    orgs = fact.filter(F.col(level) == "organization")
    return orgs.join(target, (orgs[tool] == target["_tool"]) & (orgs[level_name] == target["_org"])).drop("_tool", "_org")


def array_filter_join(
    fact: DataFrame,
    filt: DataFrame,
    project: str = "issue_project",
    boards: str = "board_ids",
    status: str = "issue_status",
    issue_type: str = "issue_type",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Fact rows that satisfy at least one filter row, where a NULL array means "no restriction".

    A filter row matches when the project is equal or not set, the boards overlap or are not set, at least one of the
    two is set, the status is listed, and the type is listed if types are given. An empty array lists nothing, so its row matches
    nothing. The fact is never joined on those OR
    conditions: its distinct (project, boards, status, type) combinations are matched through equi keys, and the fact is
    then semi-joined to the combinations that passed.

    With ``carry``, columns of the filter rows such as their level take the place of the fact's: a fact row comes once for each
    of their values that lists it.
    """
    shape = fact.select(
        F.col(project).alias("_p"), F.col(boards).alias("_b"), F.col(status).alias("_s"), F.col(issue_type).alias("_t")
    ).distinct()
    wanted = (
        filt.filter(F.col("issue_status").isNotNull())
        .filter(all_of([F.col(c).isNull() | (F.size(c) > 0) for c in ("project_name", "board_ids", "include_issue_types")]))
        .withColumn("_p", F.explode_outer("project_name"))
        .withColumn("_b", F.explode_outer("board_ids"))
        .filter(F.col("_p").isNotNull() | F.col("_b").isNotNull())
        .withColumn("_s", F.explode("issue_status"))
        .withColumn("_t", F.explode_outer("include_issue_types"))
        .select("_p", "_b", "_s", "_t", *carry)
        .distinct()
    )
    null = F.lit(None).cast("string")
    candidates = (
        shape.withColumn("_fp", F.explode(F.array(F.col("_p"), null)))
        .withColumn("_fb", F.explode(F.array_distinct(F.concat(F.coalesce("_b", F.array().cast("array<string>")), F.array(null)))))
        .withColumn("_ft", F.explode(F.array(F.col("_t"), null)))
    )
    passed = candidates.join(
        wanted,
        candidates["_fp"].eqNullSafe(wanted["_p"])
        & candidates["_fb"].eqNullSafe(wanted["_b"])
        & (candidates["_s"] == wanted["_s"])
        & candidates["_ft"].eqNullSafe(wanted["_t"]),
        "inner" if carry else "left_semi",
    )
    passed = passed.select(*[candidates[c] for c in ("_p", "_b", "_s", "_t")], *[wanted[c] for c in carry]).distinct()
    fact = fact.drop(*carry)
    joined = fact.join(
        passed,
        fact[project].eqNullSafe(passed["_p"])
        & fact[boards].eqNullSafe(passed["_b"])
        & (fact[status] == passed["_s"])
        & fact[issue_type].eqNullSafe(passed["_t"]),
        "inner" if carry else "left_semi",
    )
    return joined.drop("_p", "_b", "_s", "_t") if carry else joined


def url_semi_join(fact: DataFrame, urls: DataFrame, fact_url: str = "project_url", url: str = "project_url") -> DataFrame:
    """Fact rows whose repository is listed, with or without a trailing ``.git`` on either side."""
    keys = urls.select(git_url_key(url).alias("_repo")).distinct()
    return fact.join(keys, git_url_key(fact[fact_url]) == keys["_repo"], "left_semi")


def url_join(left: DataFrame, right: DataFrame, left_url: str, right_url: str) -> DataFrame:
    """Inner join of two relations on the repository, tolerant of ``.git``."""
    return left.join(right, git_url_key(left[left_url]) == git_url_key(right[right_url]))


def commit_prefix_join(commits: DataFrame, urls: DataFrame, url: str = "project_url") -> DataFrame:
    """Commits whose web URL starts with ``<repository>/commit/``.

    The repository is cut out of the commit's own URL, so the prefix test is an equi join.
    """
    keys = urls.select(git_url_key(url).alias("matched_url")).distinct()
    found = commits.filter(F.contains("web_url", F.lit("/commit/")))
    repo = F.substring_index(found["web_url"], "/commit/", 1)
    return found.join(keys, repo == keys["matched_url"])


def offering_filter(df: DataFrame, toggle: bool, enabled: bool, column: str = "level_1") -> DataFrame:
    """With the toggle on: keep the ``off:`` rows if offerings are enabled and any exist, else the other rows."""
    if not toggle:
        return df
    is_offering = F.col(column).like("off:%")
    if not enabled:
        return df.filter(~is_offering)
    # One aggregated value, so the whole relation never passes through a single window partition.
    found = df.select(F.coalesce(F.max(is_offering), F.lit(False)).alias("n")).scalar()
    return df.filter(is_offering == found)


def level_any_join(df: DataFrame, groups: DataFrame, value: str, levels: Sequence[str] = LEVELS[:4]) -> DataFrame:
    """Rows joined to the groups that carry their value on any of the given levels."""
    keep = [c for c in groups.columns]
    long = (
        groups.withColumn("_level_value", F.explode(F.array_distinct(F.array(*levels))))
        .filter(F.col("_level_value").isNotNull())
        .select("_level_value", *keep)
        .distinct()
    )
    return df.join(long, df[value] == long["_level_value"]).drop("_level_value")


def unpivot_levels(df: DataFrame, struct: str = "filters", levels: Sequence[str] = LEVELS) -> DataFrame:
    """Struct of arrays to rows (level_name, level_value array); levels that are not set are left out."""
    rows = F.array(
        *[F.struct(F.lit(name).alias("level_name"), F.col(f"{struct}.{name}").alias("level_value")) for name in levels]
    )
    others = [c for c in df.columns if c != struct]
    return df.select(*others, F.inline(rows)).filter(F.col("level_value").isNotNull())


def level_filter(df: DataFrame, level_name: str, wanted: Sequence[str]) -> DataFrame:
    """Long-form level filter: the level's name matches and its values overlap the wanted ones."""
    return df.filter(
        (F.col("level_name") == level_name) & F.arrays_overlap("level_value", F.array(*[F.lit(w) for w in wanted]))
    )


def child_levels(groups: DataFrame, parent: str, value: str, child: str) -> DataFrame:
    """Cascading drop-down: the distinct child level under one parent value, in order."""
    return (
        groups.filter((F.col(parent) == value) & F.col(child).isNotNull()).select(child).distinct().orderBy(child)
    )


def kpis_matching(kpis: DataFrame, regex: str, columns: Sequence[str] = ("kpi_name", "kpi_identifier")) -> DataFrame:
    """Metric rows whose name or identifier matches, ignoring case; a NULL name counts as empty."""
    return kpis.filter(any_of([F.lower(F.coalesce(F.col(c), F.lit(""))).rlike(regex) for c in columns]))


def with_kpis(values: DataFrame, wanted: Sequence[str], column: str = "kpi_uuids", present: bool = True) -> DataFrame:
    """Filter rows that contain any of the metric ids, or none of them. A NULL array contains nothing."""
    hit = F.coalesce(F.arrays_overlap(column, F.array(*[F.lit(w) for w in wanted])), F.lit(False))
    return values.filter(hit if present else ~hit)


def name_in_arrays(fact: DataFrame, filt: DataFrame, name: str, names: str) -> DataFrame:
    """Rows whose name is an element of any filter array; NULL arrays and NULL names never match."""
    wanted = filt.select(F.explode(names).alias("_name")).distinct()
    return fact.join(wanted, fact[name] == wanted["_name"], "left_semi")


def tag_filter(df: DataFrame, wanted: Sequence[str], tags: str = "tags") -> DataFrame:
    """Rows with at least one of the wanted ``type:value`` tags."""
    texts = F.transform(tags, lambda t: F.concat(t["type"], F.lit(":"), t["value"]))
    return df.filter(F.arrays_overlap(texts, F.array(*[F.lit(w) for w in wanted])))


def matching_tag_arrays(df: DataFrame, wanted: DataFrame, tags: str, sentinel: str) -> DataFrame:
    """The distinct tag arrays (``_tags``) that hold a wanted tag, or all of them if the sentinel is wanted.

    The distinct arrays are matched first, so the fact itself is neither exploded nor joined on an OR.
    """
    names = wanted.toDF("_tag").distinct()
    lookups = F.array_union(F.coalesce(F.col(tags), F.array().cast("array<string>")), F.array(F.lit(sentinel)))
    shapes = df.select(F.col(tags).alias("_tags"), lookups.alias("_lookups")).distinct()
    return (
        shapes.withColumn("_one", F.explode("_lookups"))
        .join(names, F.col("_one") == F.col("_tag"), "left_semi")
        .select("_tags")
        .distinct()
    )


def tag_wildcard(df: DataFrame, wanted: DataFrame, tags: str = "pipeline_tags", sentinel: str = "X") -> DataFrame:
    """Rows whose tag array holds a wanted tag; the sentinel ``'X'`` in the wanted tags lets every row pass."""
    passed = matching_tag_arrays(df, wanted, tags, sentinel)
    return df.join(passed, df[tags].eqNullSafe(passed["_tags"]), "left_semi")


def scoped_names(df: DataFrame, param: str, scope: Column) -> DataFrame:
    """Distinct parameter values for a drop-down, with the tenant and date scope applied.

    The scope belongs here as well as in the metric query: without it, names of other tenants leak into the list.
    """
    return df.filter((F.col("param_name") == param) & scope).select(F.col("parameter").alias("name")).distinct()


# Words that mark each delivery stage, looked for in the step's type and name.
STAGES: Mapping[str, Sequence[str]] = {
    "code_review": ("%review%",),
    "ci": ("%build%", "%compile%"),
    "security": ("%security%", "%scan%"),
    "quality": ("%quality%", "%sonar%"),
    "qa": ("%test%", "%qa%"),
    "deploy": ("%deploy%",),
    "production": ("%production%", "%release%"),
}


def stage_is(stage: str, step_type: str = "pipeline_step_type", step_name: str = "pipeline_step_name") -> Column:
    """True when the step belongs to the stage. One closed OR, so AND-ing a scope to it restricts every arm."""
    return like_any(step_type, STAGES[stage]) | like_any(step_name, STAGES[stage])


def stage_filter(df: DataFrame, stage: str, scope: Column) -> DataFrame:
    return df.filter(scope & stage_is(stage))


def fallback_scope(integration: Sequence[str], tenant: str, url: str = "project_url", org: str = "org_name") -> Column:
    """Scope by the integration's repositories; when there are none, by the tenant, so that no other tenant leaks in."""
    return F.col(url).isin(list(integration)) if integration else F.col(org) == tenant


def semi_scope(fact: DataFrame, scope: DataFrame, column: str) -> DataFrame:
    """Rows whose value is listed in the scope relation."""
    return fact.join(scope.select(column).distinct(), column, "left_semi")


def find_value(df: DataFrame, value: str) -> DataFrame:
    """Rows that carry a value in any string column (as a part of it) or string-array column (as an element)."""
    tests = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind == "string":
            tests.append(F.coalesce(F.contains(F.col(f.name), F.lit(value)), F.lit(False)))
        elif kind == "array<string>":
            tests.append(F.coalesce(F.array_contains(f.name, value), F.lit(False)))
    return df.filter(any_of(tests))


def contains_true(array: str | Column, value: Column) -> Column:
    """``array_contains`` that gives false instead of NULL."""
    return F.coalesce(F.array_contains(col(array), value), F.lit(False))
