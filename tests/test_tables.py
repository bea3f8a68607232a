"""Table jobs: rewrites, scoped deletes, snapshots, JSON packing; profiles and calendars."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import calendar as cl
from flowgauge.operators import profile as pf
from flowgauge.operators import release as rl
from flowgauge.session import scratch_path
from flowgauge.sources import tables as tb


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, "o1", "a"), (2, "o1", "b"), (3, None, "a"), (4, "o2", None)], "id int, org_name string, tool string")


def test_delete_keeps_rows_of_unknown_scope(table, rows):
    assert rows(tb.keep_after_delete(table, F.col("org_name") == "o1"), "id") == [(3,), (4,)]
    assert rows(tb.delete_counts(table, F.col("org_name") == "o1")) == [(2, 2)]
    assert rows(tb.keep_after_delete(table, tb.owned_by("o1", ["a"])), "id") == [(2,), (3,), (4,)]


def test_replace_scope_is_idempotent(table, rows):
    new = table.filter("id = 1").withColumn("id", F.lit(9))
    scope = F.col("org_name") == "o1"
    once = tb.replace_scope(table, new, scope)
    assert rows(tb.replace_scope(once, new, scope)) == rows(once)


def test_insert_missing_update_and_add(spark, table, rows):
    more = spark.createDataFrame([(1, "zz", "zz"), (7, "o7", "c")], table.schema)
    assert rows(tb.insert_missing(table, more, ["id"]), "id") == [(1,), (2,), (3,), (4,), (7,)]
    swapped = tb.update_where(table, F.col("org_name") == "o1", {"org_name": F.col("tool"), "tool": F.col("org_name")})
    assert rows(swapped.filter("id < 4")) == [(1, "a", "o1"), (2, "b", "o1"), (3, None, "a")]
    added = tb.add_columns(table, {"tool": "int", "n": "bigint"})
    assert added.schema["n"].dataType.simpleString() == "bigint" and added.schema["tool"].dataType.simpleString() == "string"


def test_snapshot_of_a_scope_reads_its_folder_only(spark, table, rows):
    path = scratch_path(spark, "t")
    tb.export_scope(table, path, "org_name")
    back = tb.restore_scope(spark, path, "id INT, tool STRING, org_name STRING", "org_name", ["o1"])
    assert rows(back, "id", "tool") == [(1, "a"), (2, "b")]
    assert "PartitionFilters: [isnotnull(org_name" in back._jdf.queryExecution().executedPlan().toString()


def test_append_twice(spark, table):
    path = scratch_path(spark, "t")
    tb.append(table, path)
    assert tb.append(table, path).count() == 8


def test_pack_json_splits_large_keys(spark, rows):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("k"), "id")
    packed = tb.pack_json(df, ["k"], ["id"], "objects", per_row=500)
    sizes = [r[0] for r in packed.select(F.size("objects")).collect()]
    assert sum(sizes) == 5000 and max(sizes) < 1500 and len(sizes) >= 9
    assert rl.unpack(packed, "objects", ["k"], "id BIGINT").exceptAll(df).count() == 0


def test_literal_relations_carry_no_hint(spark):
    plan = tb.literal_rel(spark, [(1,)], "a int")._jdf.queryExecution().analyzed().toString()
    assert "hint" not in plan.lower()


def test_unreadable_json_gives_nulls(spark, rows):
    df = spark.createDataFrame([("v1", ['{"isdefect":"true"}', "{oops", None]), ("v2", None), ("v3", [])], "fix_version string, defects array<string>")
    assert rows(rl.defect_ratio(df)) == [("v1", 3, 1, 33.33)]


def test_median_is_interpolated_over_done_issues(spark, rows):
    objs = [f'{{"is_done":"true","current_time":{n}}}' for n in (10, 10, 30, 41)] + ['{"is_done":"false"}']
    df = spark.createDataFrame([("v1", objs), ("v2", ['{"is_done":"false"}'])], "fix_version string, issues array<string>")
    assert rows(rl.issue_completion(df)) == [("v1", 5, 4, 80.0, 20.0), ("v2", 1, 0, 0.0, None)]


def test_set_diff_duplicates_and_nulls(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (None,), (3,)], "k int")
    assert rows(pf.set_diff(a, b, ["k"])) == sorted([(1, "only_left"), (2, "shared"), (3, "only_right"), (None, "shared")], key=repr)
    assert rows(pf.null_rates(a)) == [("k", 1, 25.0)]
    dup = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, id int")
    assert rows(pf.duplicates(dup, ["k"], "id")) == [("x", 1, 2), ("x", 2, 2)]


def test_join_matches_equals_the_join(spark, rows):
    a = spark.createDataFrame([("x",)] * 5 + [("y",), (None,)], "a string")
    b = spark.createDataFrame([("x",)] * 3 + [("z",), (None,)], "b string")
    assert rows(pf.join_matches(a, b, "a", "b")) == [(1, 15)]
    assert a.join(b, F.col("a") == F.col("b")).count() == 15


def test_tokens_come_from_whole_texts(spark, rows):
    df = spark.createDataFrame([("x" * 30000 + " id-1 id-2 id-1",), (None,)], "t string")
    assert rows(pf.extract_tokens(df, ["t"], r"id-\d")) == [("t", "id-1"), ("t", "id-2")]


def test_combo_matrix_has_every_combination(spark, rows):
    df = spark.createDataFrame([(date(2024, 1, 1), "a", 3), (date(2024, 2, 1), "b", 4)], "day date, s string, n int")
    got = rows(pf.combo_matrix(df, "day", "n", {"jan": ("2024-01-01", "2024-01-31"), "all": ("2024-01-01", "2024-12-31")}, {"any": F.lit(True), "a": F.col("s") == "a"}))
    assert got == [("all", "a", 3), ("all", "any", 7), ("jan", "a", 3), ("jan", "any", 3)]


def days_between(spark, a, b):
    return spark.range(1).selectExpr(f"explode(sequence(date'{a}', date'{b}')) AS day")


def test_day_types_and_weekdays(spark):
    df = days_between(spark, "2024-12-20", "2025-01-10")
    got = {r[0]: (r[1], r[2]) for r in df.select("day", cl.day_type("day", ["2025-01-01"], [("2024-12-24", "2024-12-26")]), cl.last_weekday_before("day")).collect()}
    assert len(got) == 22
    for d, (kind, before) in got.items():
        want = "shutdown" if date(2024, 12, 24) <= d <= date(2024, 12, 26) else "holiday" if d == date(2025, 1, 1) else "weekend" if d.weekday() > 4 else "normal"
        assert kind == want
        back = d - timedelta(days=1)
        while back.weekday() > 4:
            back -= timedelta(days=1)
        assert before == back


def test_windows_overlap(spark, rows):
    df = days_between(spark, "2024-01-01", "2024-01-31")
    got = cl.tag_windows(df, "day", {"inner": (10, 8), "outer": (12, 5)}, "2024-01-31").groupBy("window_name").count()
    assert rows(got) == [("inner", 3), ("outer", 8)]


@pytest.mark.parametrize("n", [1, 4, 8, 20, 40])
def test_business_day_picks_are_evenly_spaced(spark, n):
    got = cl.business_day_picks(days_between(spark, "2024-02-01", "2024-03-31"), n).orderBy("day").collect()
    for month in {r["month"] for r in got}:
        pool = [r["day"] for r in got if r["month"] == month]
        size = min(n, len(pool))
        want = [pool[int(i * (len(pool) / size))] for i in range(size)]
        assert [r["day"] for r in got if r["month"] == month and r["picked"]] == want


def test_sprints_start_on_monday_and_the_last_is_cut(spark, rows):
    bounds = spark.createDataFrame([(date(2024, 1, 3), date(2024, 2, 10))], "lo date, hi date")
    got = rows(cl.sprint_windows(bounds, "2024-01-25"))
    assert got == [
        (1, date(2024, 1, 8), date(2024, 1, 21), "closed"), (2, date(2024, 1, 22), date(2024, 2, 4), "active"),
        (3, date(2024, 2, 5), date(2024, 2, 10), "active"),
    ]


def test_insert_missing_takes_one_row_of_a_repeated_key(spark, rows):
    target = spark.createDataFrame([(1, "a")], "id long, v string")
    source = spark.createDataFrame([(2, "z"), (2, "b"), (1, "c")], "id long, v string")
    assert rows(tb.insert_missing(target, source, ["id"])) == [(1, "a"), (2, "b")]


def test_pack_json_splits_equal_objects(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    sizes = sorted(r[0] for r in tb.pack_json(df, ["k"], ["v"], "packed", per_row=100).select(F.size("packed")).collect())
    assert sizes == [100] * 5
