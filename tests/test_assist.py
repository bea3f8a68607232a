"""Assistant usage: splits that must sum, step functions, trailing distinct users."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowgauge.operators import assist as aa

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def largest_remainder(total, weights):
    s = sum(weights.values())
    if s == 0:
        return dict.fromkeys(weights, 0)
    out = {k: total * w // s for k, w in weights.items()}
    order = sorted(weights, key=lambda k: (-(total * weights[k] % s), k))
    for k in order[: total - sum(out.values())]:
        out[k] += 1
    return out


@SLOW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("uvwxyz"), st.integers(0, 50)), min_size=1, max_size=25), st.integers(0, 1000))
def test_apportion_sums_exactly(spark, parts, total):
    df = spark.createDataFrame([(*p, total) for p in parts], "k string, c string, w long, total long")
    got = {(r["k"], r["c"]): r["share"] for r in aa.apportion(df, ["k"], "c", "w", "total").collect()}
    weights = defaultdict(lambda: defaultdict(int))
    for k, c, w in parts:
        weights[k][c] += w
    assert got == {(k, c): n for k, ws in weights.items() for c, n in largest_remainder(total, ws).items()}


@SLOW
@given(st.lists(st.integers(0, 500), min_size=1, max_size=40, unique=True), st.integers(0, 300))
def test_split_even_gives_the_rest_to_the_first(spark, ids, total):
    df = spark.createDataFrame([("k", i, total) for i in ids], "k string, id long, total long")
    got = [r["share"] for r in aa.split_even(df, ["k"], "total", "id", F.expr("id div 50")).orderBy("id").collect()]
    base, rest = divmod(total, len(ids))
    assert got == [base + (i < rest) for i in range(len(ids))]


def test_trailing_users_against_brute_force(spark, rows):
    rng = random.Random(3)
    start = date(2024, 1, 1)
    events = [("o1", f"u{rng.randrange(12)}", start + timedelta(days=rng.randrange(60))) for _ in range(150)]
    events += [("o2", "solo", start)]
    df = spark.createDataFrame(events, "org_name string, user_login string, usage_date date")
    a, b = date(2024, 1, 20), date(2024, 2, 20)
    got = {(r["org_name"], r["usage_date"]): (r["dau"], r["wau"], r["mau"]) for r in aa.trailing_users(df, {"dau": 1, "wau": 7, "mau": 28}, a.isoformat(), b.isoformat()).collect()}
    for i in range((b - a).days + 1):
        d = a + timedelta(days=i)
        for org in ("o1", "o2"):
            want = tuple(len({u for o, u, x in events if o == org and d - timedelta(days=w - 1) <= x <= d}) for w in (1, 7, 28))
            assert got[(org, d)] == want
    assert len(got) == 2 * ((b - a).days + 1)


def test_as_of_before_first_step_is_null(spark, rows):
    steps = spark.createDataFrame([("o", date(2024, 1, 3), 5), ("o", date(2024, 1, 6), 8)], "org_name string, from_day date, allocated int")
    df = spark.createDataFrame([("o", date(2024, 1, d)) for d in (2, 3, 5, 6, 30)] + [("p", date(2024, 1, 5))], "org_name string, usage_date date")
    got = rows(aa.as_of(df, steps, ["org_name"], "usage_date", "allocated"), "org_name", "usage_date", "allocated")
    assert [r[2] for r in sorted(got)] == [None, 5, 5, 8, 8, None]


def test_ramp(spark, rows):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3, 11, 12, 25)], "d date")
    quota = aa.ramp("d", F.lit("2024-01-02").cast("date"), F.lit(100), 10)
    assert [r[1] for r in sorted(rows(df.select("d", quota.alias("q"))))] == [0, 10, 20, 100, 100, 100]


def test_nest_and_unnest_are_inverse(spark, tables, rows):
    nested = aa.nest_totals(tables.assist, ["language", "model"], "t")
    flat = aa.rollup(tables.assist, ["usage_date", "language", "model"], aa.SUMS[1:3])
    assert rows(aa.unnest_totals(nested, "t"), *flat.columns) == rows(flat)
    assert aa.unnest_totals(nested.withColumn("t", F.array().cast(nested.schema["t"].dataType)), "t").count() == 0


def test_billing_active_never_exceeds_total(spark, rows):
    df = spark.createDataFrame([(5, 9), (5, 2), (0, 0)], "total long, active long")
    cols = [e.alias(n) for n, e in aa.billing_snapshot(F.col("total"), F.col("active")).items()]
    assert rows(df.select(*cols)) == [(0, 0, 0), (5, 2, 3), (5, 5, 0)]


def test_heavy_users_count_business_days_only(spark, rows):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(14)]
    work = [d for d in days if d.weekday() < 5]
    events = [("o", "steady", d) for d in work[:8]] + [("o", "weekender", d) for d in days if d not in work] + [("o", "some", d) for d in work[:7]]
    df = spark.createDataFrame(events, "org_name string, user_login string, usage_date date")
    assert aa.business_days("2024-01-01", "2024-01-14") == 10
    assert rows(aa.heavy_users(df, "2024-01-01", "2024-01-14"), "user_login", "active_days") == [("steady", 8)]


def test_sample_is_stable_and_sized(spark, rows):
    df = spark.createDataFrame([(f"u{i}", i % 2) for i in range(40)], "u string, g int")
    first, second = (rows(aa.sample_n(x, 5, "u", ["g"])) for x in (df, df.repartition(9)))
    assert first == second and len(first) == 10
    assert rows(aa.sample_n(df, 7, "u")) == rows(aa.sample_n(df.repartition(3), 7, "u"))


def test_as_of_reaches_the_last_fact(spark):
    facts = spark.createDataFrame([("o", date(2024, 3, 1)), ("o", date(2023, 12, 1))], "org_name string, usage_date date")
    steps = spark.createDataFrame([("o", date(2024, 1, 1), 5)], "org_name string, from_day date, allocated long")
    got = {r.usage_date: r.allocated for r in aa.as_of(facts, steps, ["org_name"], "usage_date", "allocated").collect()}
    assert got == {date(2024, 3, 1): 5, date(2023, 12, 1): None}


def test_trailing_users_lists_quiet_organisations(spark):
    usage = spark.createDataFrame([("o1", "u", date(2024, 1, 10)), ("o2", "v", date(2023, 1, 1))], "org_name string, user_login string, usage_date date")
    got = {(r.org_name, r.usage_date.day): r.wau for r in aa.trailing_users(usage, {"wau": 7}, "2024-01-10", "2024-01-11").collect()}
    assert got == {("o1", 10): 1, ("o1", 11): 1, ("o2", 10): 0, ("o2", 11): 0}


def test_apportion_of_great_weights(spark):
    df = spark.createDataFrame([("k", "a", 5 * 10**12, 3 * 10**6), ("k", "b", 5 * 10**12, 3 * 10**6)], "k string, c string, w long, total long")
    assert {r.share for r in aa.apportion(df, ["k"], "c", "w", "total").collect()} == {1500000}


def test_a_frequent_ticket_is_split_over_tasks(spark):
    """Most commits name one ticket; the bugs are listed twice, one without a key. Counts stay, and the hot ticket is dealt to several tasks."""
    commits = spark.range(4000, numPartitions=8).select(
        F.concat(F.lit("c"), "id").alias("commit_id"),
        F.array(F.lit("none"), F.concat(F.lit("ISS-"), (F.col("id") % 300).cast("string"))).alias("commit_tickets"),
        F.array(F.lit("a"), F.when(F.col("id") % 2 == 0, F.lit("b"))).alias("ai_tool"),
    )
    issues = spark.range(600).select(
        F.when(F.col("id") != 0, F.concat(F.lit("ISS-"), (F.col("id") % 300).cast("string"))).alias("issue_key"),
        F.when(F.col("id") % 3 == 0, F.lit("Bug")).otherwise(F.lit("Task")).alias("issue_type"),
    )
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        out = aa.tool_quality(commits, issues)
        got = sorted((tuple(r) for r in out.collect()), key=repr)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    bug = {i % 300 for i in range(600) if i % 3 == 0}
    ids = {"a": range(4000), "b": range(0, 4000, 2), None: range(1, 4000, 2)}
    want = [(tool, len(i), n := sum(c % 300 in bug for c in i), round(n * 100 / len(i), 2)) for tool, i in ids.items()]
    assert got == sorted(want, key=repr)
    assert "skew=true" in plan.split("== Initial Plan ==")[0]
