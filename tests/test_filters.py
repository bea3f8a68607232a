"""Filter layer on hand-made frames: NULLs, empty arrays, sentinels, spelling differences."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import filters as fl

GROUPS = "filter_group_id string, level_1 string, level_2 string, level_3 string, level_4 string, level_5 string, active boolean"
VALUES = "filter_group_id string, tool_type string, filter_name string, filter_values array<string>, kpi_uuids array<string>, active boolean"


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(
        [("g1", "L1", None, "L3", None, None, True), ("g2", "L1", None, "M3", None, None, True), ("g3", "L1", None, "N3", None, None, False)], GROUPS
    )


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame(
        [
            ("g1", "jira", "project_name", ["A", "B"], ["k1", "k2"], True),
            ("g1", "jira", "project_name", ["B", "C"], ["k1"], True),
            ("g1", "jira", "issue_status", [], ["k1"], True),
            ("g2", "jira", "project_name", None, ["k1"], True),
            ("g2", "jira", "board_ids", ["7"], ["k1"], True),
            ("g2", "jira", "board_ids", ["8"], ["k1"], False),
            ("g3", "jira", "board_ids", ["9"], ["k1"], True),
            ("g1", "jira", "board_ids", ["1"], None, True),
        ],
        VALUES,
    )


def test_flatten_keeps_unset_and_empty_apart(groups, values, rows):
    flat = fl.flatten_filters(groups, values)
    got = rows(flat, "filter_group_id", "kpi", "project_name", "issue_status", "board_ids")
    # The empty list of issue_status is kept: it allows nothing, while NULL sets no restriction.
    assert got == [("g1", "k1", ["A", "B", "C"], [], None), ("g1", "k2", ["A", "B"], None, None), ("g2", "k1", None, None, ["7"])]


def test_scope_values_agree_with_the_flattened_arrays(groups, values, rows):
    direct = rows(fl.scope_values(fl.filter_rows(groups, values), "project_name", "k1", level_1="L1"))
    flat = fl.flatten_filters(groups, values).filter(fl.in_scope("k1", level_1=["L1"])).select(F.explode("project_name")).distinct()
    assert direct == rows(flat) == [("A",), ("B",), ("C",)]


def test_scope_values_outer_gives_sentinels(groups, values, rows):
    flat = fl.flatten_filters(groups, values)
    got = rows(fl.scope_values_outer(flat, ["project_name", "board_ids"], "k1", level_3="M3"), "project_name", "board_ids")
    assert got == [("x", "7")]


def test_wildcard_join_matches_the_or_condition(spark, rows):
    facts = [(t, lv, n, i) for i, (t, lv, n) in enumerate(itertools.product(("t1", "t2"), ("organization", "team"), ("o1", "o2", "x", None)))]
    filts = [("t1", "x", "x"), ("t1", "o1", "x"), ("t1", "o2", "o1"), ("t2", "o2", "x"), ("t2", "o1", "o2")]
    fact = spark.createDataFrame(facts, "tool string, level string, level_name string, id int")
    filt = spark.createDataFrame(filts, "tool_type string, org_name string, team_names string")
    want = [
        (f[3],)
        for f, (tool, org, team) in itertools.product(facts, filts)
        if f[0] == tool and ((team != "x" and f[1] == "team" and f[2] == team) or (team == "x" and f[1] == "organization" and (org == "x" or f[2] == org)))
    ]
    assert rows(fl.wildcard_join(fact, filt), "id") == sorted(want, key=repr)


def overlap(a, b):
    return bool(set(a or []) & set(b or []))


def test_array_filter_join_matches_the_nested_loop(spark, rows):
    facts = list(
        itertools.product(("P", "Q", None), (["1", "2"], ["3"], [], None), ("Done", "done", None), ("Bug", None))
    )
    facts = [(*f, i) for i, f in enumerate(facts * 2)]
    filts = [
        (["P"], None, ["Done"], None), (["Q"], ["2", "3"], ["Done", "done"], ["Bug"]), (None, ["1"], ["done"], None),
        (None, None, ["Done"], None), (["P"], ["3"], None, None), (["Q"], None, ["done"], []), ([], ["3"], ["Done"], ["Bug", "Task"]),
    ]
    fact = spark.createDataFrame(facts, "issue_project string, board_ids array<string>, issue_status string, issue_type string, id int")
    filt = spark.createDataFrame(
        filts, "project_name array<string>, board_ids array<string>, issue_status array<string>, include_issue_types array<string>"
    )
    # An empty array lists nothing, so its row matches nothing; only a missing one sets no restriction.
    want = set()
    for p, b, s, t, i in facts:
        for fp, fb, fs, ft in filts:
            if fs and not (fp is None and fb is None) and (fp is None or p in fp) and (fb is None or overlap(fb, b)) and s in fs and (ft is None or t in ft):
                want.add((i,))
    assert rows(fl.array_filter_join(fact, filt), "id") == sorted(want, key=repr)


def test_url_joins_tolerate_git_suffix(spark, rows):
    fact = spark.createDataFrame([("h/a.git", 1), ("h/a", 2), ("h/b", 3), (None, 4), ("h/agit", 5)], "project_url string, id int")
    urls = spark.createDataFrame([("h/a",), ("h/a.git",), ("h/b.git",)], "project_url string")
    assert rows(fl.url_semi_join(fact, urls), "id") == [(1,), (2,), (3,)]
    commits = spark.createDataFrame([("h/a/commit/1",), ("h/a",), ("h/ab/commit/2",), ("h/b/commit/commit/3",)], "web_url string")
    assert rows(fl.commit_prefix_join(commits, urls), "web_url") == [("h/a/commit/1",), ("h/b/commit/commit/3",)]


def test_offering_filter(spark, rows):
    df = spark.createDataFrame([("off:1",), ("unit",), (None,)], "level_1 string")
    none = spark.createDataFrame([("unit",), ("other",)], "level_1 string")
    assert rows(fl.offering_filter(df, True, True)) == [("off:1",)]
    assert rows(fl.offering_filter(df, True, False)) == [("unit",)]
    assert rows(fl.offering_filter(none, True, True)) == [("other",), ("unit",)]
    assert fl.offering_filter(df, False, True).count() == 3


def test_level_any_join_counts_a_group_once(spark, rows):
    groups = spark.createDataFrame([("g1", "A", "A", None, "B"), ("g2", "C", None, None, None)], "id string, level_1 string, level_2 string, level_3 string, level_4 string")
    df = spark.createDataFrame([("A",), ("B",), ("Z",), (None,)], "v string")
    assert rows(fl.level_any_join(df, groups, "v"), "v", "id") == [("A", "g1"), ("B", "g1")]


def test_stage_filter_stays_inside_the_scope(spark, rows):
    df = spark.createDataFrame(
        [("mine", "Review", "x"), ("other", "Review", "code review"), ("mine", None, "peer-review"), ("mine", "build", None)],
        "org string, pipeline_step_type string, pipeline_step_name string",
    )
    assert rows(fl.stage_filter(df, "code_review", F.col("org") == "mine"), "org", "pipeline_step_name") == [("mine", "peer-review"), ("mine", "x")]


def test_scoped_names_do_not_leak_other_tenants(spark, rows):
    df = spark.createDataFrame([("o1", "language", "Go"), ("o2", "language", "Ada"), ("o1", "editor", "vi")], "org string, param_name string, parameter string")
    assert rows(fl.scoped_names(df, "language", F.col("org") == "o1")) == [("Go",)]


def test_fallback_scope(spark, rows):
    df = spark.createDataFrame([("o1", "u1"), ("o2", "u2")], "org_name string, project_url string")
    assert rows(df.filter(fl.fallback_scope([], "o1"))) == [("o1", "u1")]
    assert rows(df.filter(fl.fallback_scope(["u2"], "o1"))) == [("o2", "u2")]


def test_tag_wildcard_and_null_arrays(spark, rows):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None), (3, []), (4, ["c", None])], "id int, pipeline_tags array<string>")
    wanted = spark.createDataFrame([("a",), ("a",)], "t string")
    anything = spark.createDataFrame([("X",), ("c",)], "t string")
    assert rows(fl.tag_wildcard(df, wanted), "id") == [(1,)]
    assert rows(fl.tag_wildcard(df, anything), "id") == [(1,), (2,), (3,), (4,)]


def test_names_tags_kpis_and_find(spark, rows):
    df = spark.createDataFrame([(1, "A", ["k"]), (2, None, None), (3, "B", [])], "id int, name string, arr array<string>")
    filt = spark.createDataFrame([(["A", None],), (None,)], "names array<string>")
    assert rows(fl.name_in_arrays(df, filt, "name", "names"), "id") == [(1,)]
    assert rows(fl.with_kpis(df, ["k"], "arr"), "id") == [(1,)]
    assert rows(fl.with_kpis(df, ["k"], "arr", present=False), "id") == [(2,), (3,)]
    assert rows(fl.find_value(df, "k"), "id") == [(1,)]
    assert rows(fl.kpis_matching(df, "^b", ["name"]), "id") == [(3,)]
    tags = spark.createDataFrame([(1, [("env", "prod")]), (2, None)], "id int, tags array<struct<type:string,value:string>>")
    assert rows(fl.tag_filter(tags, ["env:prod"]), "id") == [(1,)]
