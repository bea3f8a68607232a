"""AI-assistant usage, seats and licences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions.columns import col, is_weekday, ratio, seconds_between
from flowgauge.operators.ordering import carried_value, position_in_key, running_total, spread_to_next, top_rows

SUMS = (
    "user_initiated_interaction_count",
    "code_generation_activity_count",
    "code_acceptance_activity_count",
    "loc_suggested_to_add_sum",
    "loc_added_sum",
    "loc_deleted_sum",
)


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def rollup(usage: DataFrame, dims: Sequence[str], sums: Sequence[str] = SUMS) -> DataFrame:
    """Flat rollup on any dimensions: user x feature, user x IDE, user x language x model, organisation x ..."""
    return usage.groupBy(*dims).agg(*[F.sum(s).alias(s) for s in sums])


def user_day(usage: DataFrame) -> DataFrame:
    """One row per organisation, user and day."""
    return usage.groupBy("usage_date", "org_name", "user_login").agg(
        *[F.sum(s).alias(s) for s in SUMS], F.bool_or("used_chat").alias("used_chat"), F.bool_or("used_agent").alias("used_agent")
    )


def org_day(users: DataFrame) -> DataFrame:
    """Organisation-day totals. The input has one row per user and day, so users are counted without a distinct."""
    return users.groupBy("usage_date", "org_name").agg(
        *[F.sum(s).alias(s) for s in SUMS],
        F.count("*").alias("daily_active_users"),
        F.count_if("used_chat").alias("daily_chat_users"),
        F.count_if("used_agent").alias("daily_agent_users"),
    )


def nest_totals(
    usage: DataFrame, dims: Sequence[str], alias: str, keys: Sequence[str] = ("usage_date",), sums: Sequence[str] = SUMS[1:3]
) -> DataFrame:
    """Per key, a sorted array with one struct per combination of the dimensions.

    Rows are summed per key and combination first, so an array has as many entries as there are combinations.
    """
    flat = rollup(usage, [*keys, *dims], sums)
    return flat.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*dims, *sums))).alias(alias))


def unnest_totals(df: DataFrame, column: str, keys: Sequence[str] = ("usage_date",)) -> DataFrame:
    """The array of structs back to rows. A NULL or empty array gives none."""
    return df.select(*keys, F.inline(column))


def acceptance_rate(keys: Sequence[str], usage: DataFrame) -> DataFrame:
    """Accepted over generated, as a ratio of sums; NULL when nothing was generated."""
    accepted, generated = F.sum("code_acceptance_activity_count"), F.sum("code_generation_activity_count")
    return usage.groupBy(*keys).agg(
        accepted.alias("accepted"), generated.alias("generated"), F.round(ratio(accepted, generated, 100), 2).alias("acceptance_percent")
    )


def to_eav(usage: DataFrame, categories: Mapping[str, str], keys: Sequence[str] = ("usage_date", "org_name")) -> DataFrame:
    """Long table: one row per key, category and value, with lines suggested and accepted.

    Rows are summed over all categories at once before they fan out into one row per category.
    """
    flat = rollup(usage, [*keys, *categories.values()], ("loc_suggested_to_add_sum", "loc_added_sum"))
    pairs = F.array(*[F.struct(F.lit(n).alias("param_name"), F.col(c).alias("parameter")) for n, c in categories.items()])
    long = flat.select(*keys, "loc_suggested_to_add_sum", "loc_added_sum", F.inline(pairs))
    return long.groupBy(*keys, "param_name", "parameter").agg(
        F.sum("loc_suggested_to_add_sum").alias("total_lines_suggested"), F.sum("loc_added_sum").alias("total_lines_accepted")
    )


def eav_top(eav: DataFrame, k: int) -> DataFrame:
    """Top k values of each category by rows; ties in value order."""
    counts = eav.groupBy("param_name", "parameter").agg(
        F.count("*").alias("n_rows"),
        F.sum("total_lines_suggested").alias("total_suggested"),
        F.sum("total_lines_accepted").alias("total_accepted"),
    )
    return top_rows(counts, ["param_name"], [F.desc("n_rows"), F.asc("parameter")], k, "position")


def split_even(df: DataFrame, keys: Sequence[str], total: str, order: str, bucket: Column, alias: str = "share") -> DataFrame:
    """Split a total evenly over the rows of a key; the remainder goes to the first rows. Shares sum to the total."""
    placed = position_in_key(df, keys, [order], "_at", bucket)
    base, rest = F.expr(f"`{total}` div `_at_count`"), F.expr(f"`{total}` % `_at_count`")
    return placed.withColumn(alias, base + F.when(F.col("_at") < rest, 1).otherwise(0)).drop("_at", "_at_count")


def apportion(df: DataFrame, keys: Sequence[str], category: str, weight: str, total: str, alias: str = "share") -> DataFrame:
    """Split an integer total by weight so that the parts sum exactly (largest remainder; ties in category order).

    Weights are summed per category first: a key then has one row per category of a dictionary. Integer arithmetic
    throughout, so remainders compare exactly. With no weight at all every part is 0.
    """
    parts = df.groupBy(*keys, category).agg(F.sum(weight).cast("bigint").alias("_w"), F.max(total).cast("bigint").alias("_total"))
    per_key = Window.partitionBy(*keys)
    parts = parts.withColumn("_sum", F.sum("_w").over(per_key)).withColumn("_total", F.max("_total").over(per_key))
    parts = parts.withColumns(
        {
            "_floor": F.expr("CASE WHEN _sum > 0 THEN CAST((CAST(_total AS DECIMAL(19, 0)) * CAST(_w AS DECIMAL(19, 0))) div _sum AS BIGINT) ELSE 0L END"),
            "_rest": F.expr("CASE WHEN _sum > 0 THEN CAST((CAST(_total AS DECIMAL(19, 0)) * CAST(_w AS DECIMAL(19, 0))) % _sum AS BIGINT) ELSE 0L END"),
        }
    )
    order = per_key.orderBy(F.desc("_rest"), F.asc(category))
    missing = F.when(F.col("_sum") > 0, F.col("_total") - F.sum("_floor").over(per_key)).otherwise(0)
    parts = parts.withColumn("_missing", missing).withColumn("_at", F.row_number().over(order))
    return parts.select(
        *keys,
        category,
        F.col("_w").alias(weight),
        F.col("_total").alias(total),
        (F.col("_floor") + F.when(F.col("_at") <= F.col("_missing"), 1).otherwise(0)).alias(alias),
    )


def allocation_steps(seats: DataFrame, keys: Sequence[str] = ("org_name",)) -> DataFrame:
    """Seats allocated so far, at each day that adds some."""
    per_day = seats.groupBy(*keys, F.col("created_at").alias("from_day")).agg(F.count("*").alias("_added"))
    return running_total(per_day, keys, "from_day", "_added", "allocated").drop("_added")


def as_of(df: DataFrame, steps: DataFrame, keys: Sequence[str], at: str, value: str) -> DataFrame:
    """The value of a step function on each row's day; NULL before the first step.

    The last value is carried forward inside a key's month; see ``carried_value``. A fact at a far-off date costs one row.
    """
    return carried_value(df, steps, keys, at, "from_day", value, lambda c: F.trunc(c, "month"))


def billing_snapshot(total: Column, active: Column) -> dict[str, Column]:
    """Seat split of a billing row: active never exceeds the total."""
    capped = F.least(active, total)
    return {"total_seats": total, "active_seats": capped, "inactive_seats": total - capped}


def seat_activity(seats: DataFrame, usage: DataFrame, start: str, end: str, keys: Sequence[str] = ("org_name",)) -> DataFrame:
    """Per key and day of a range: seats allocated by then, how many were used that day and how many lay idle, and the
    interactions on them (NULL if none).

    Interval arithmetic: a seat is one mark on the day it begins, and running marks give the seats of each day. Used seats
    are the user-days joined to the seats they fall on. Nothing is multiplied by the days, so what is shuffled grows with
    seats plus usage.
    """
    given = seats.filter(F.col("created_at") <= day(end))
    marks = given.groupBy(*keys, F.greatest(F.col("created_at"), day(start)).alias("_from")).agg(F.count("*").alias("_added"))
    held = running_total(marks, keys, "_from", "_added", "seats")
    # The first mark of a key must not reach back to days before it.
    days = spread_to_next(held, keys, "_from", day(start), day(end), "usage_date").filter(F.col("usage_date") >= F.col("_from"))
    user_days = usage.filter(F.col("usage_date").between(day(start), day(end))).groupBy("user_login", "usage_date").agg(F.count("*").alias("_n"))
    on_seats = user_days.join(given.select(*keys, F.col("assignee_login").alias("user_login"), "created_at"), "user_login")
    used = on_seats.filter(F.col("created_at") <= F.col("usage_date")).groupBy(*keys, "usage_date").agg(F.count("*").alias("active"), F.sum("_n").alias("interactions"))
    out = days.select(*keys, "usage_date", "seats").join(used, [*keys, "usage_date"], "left")
    active = F.coalesce("active", F.lit(0))
    return out.select(*keys, "usage_date", "seats", active.alias("active"), (F.col("seats") - active).alias("inactive"), "interactions")


def business_days(start: str, end: str) -> int:
    """Number of weekdays from start to end, both included."""
    a, b = date.fromisoformat(start), date.fromisoformat(end)
    return sum((a + timedelta(days=i)).weekday() < 5 for i in range((b - a).days + 1))


def heavy_users(usage: DataFrame, start: str, end: str, share: float = 0.75) -> DataFrame:
    """Users active on at least a share of the business days of the window."""
    n = business_days(start, end)
    inside = usage.filter(F.col("usage_date").between(day(start), day(end)) & is_weekday("usage_date"))
    return (
        inside.groupBy("org_name", "user_login")
        .agg(F.count_distinct("usage_date").alias("active_days"))
        .withColumn("active_share", F.round(F.col("active_days") / F.lit(n), 4))
        .filter(F.col("active_days") >= share * n)
    )


def adoption(allocated: Column, active: Column) -> dict[str, Column]:
    """Adoption rate in percent and the gap of unused licences."""
    return {"adoption_percent": F.round(ratio(active, allocated, 100), 2), "unused_licenses": allocated - active}


def ramp(at: str | Column, start: str | Column, cap: str | Column, days: int = 30) -> Column:
    """Quota that grows in a straight line from the start date to the cap over some days; 0 before."""
    at, start, cap = col(at), col(start), col(cap)
    done = F.least(F.datediff(at, start) + 1, F.lit(days))
    return F.when(at < start, 0).otherwise(F.round(cap * done / F.lit(days), 0)).cast("bigint")


def engaged_users(usage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct users per Monday week and keys."""
    return usage.groupBy(F.trunc("usage_date", "week").alias("week"), *keys).agg(
        F.count_distinct("user_login").alias("engaged_users")
    )


def numbered_users(usage: DataFrame, user: str = "user_login", parts: int = 1024) -> DataFrame:
    """Each user with a number from 1 without gaps. Users are numbered inside ``parts`` hash parts; where a part begins
    comes from one small map of the parts' sizes, so no task numbers more than a part."""
    users = usage.select(user).filter(F.col(user).isNotNull()).distinct().withColumn("_part", F.pmod(F.xxhash64(user), F.lit(parts)))
    sizes = users.groupBy("_part").agg(F.count("*").alias("_n")).agg(F.collect_list(F.struct("_part", "_n")).alias("all"))

    def before(part: Column) -> Column:
        return F.aggregate(F.filter("all", lambda x: x["_part"] < part), F.lit(0).cast("long"), lambda total, x: total + x["_n"])

    begins = sizes.select(F.map_from_entries(F.transform("all", lambda x: F.struct(x["_part"], before(x["_part"]))))).scalar()
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(user))
    return users.select(user, (F.element_at(begins, F.col("_part")) + inside).alias("user_number"))


def weekly_matrix(usage: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Per week, every subtotal over the dimensions (a cube): lines, generations and distinct users.

    Distinct users are bitmaps over user numbers, 32,768 users to a bitmap: exact sets that can be merged. Rows become one
    per week, dimensions and bitmap before the cube multiplies them, so no user row is expanded; a subtotal's
    bitmaps are merged and their bits counted. ``grouping_bits`` tells a subtotal from a NULL value.
    """
    small = rollup(usage.withColumn("week", F.trunc("usage_date", "week")), ["week", *dims, "user_login"], SUMS[1:3])
    known = small.join(numbered_users(usage), "user_login", "left")
    # Users without a login have no number: they count in the sums only.
    sets_of = known.groupBy("week", *dims, F.coalesce(F.bitmap_bucket_number("user_number"), F.lit(0)).alias("_bitmap")).agg(
        F.sum(SUMS[1]).alias("_generated"), F.sum(SUMS[2]).alias("_accepted"), F.bitmap_construct_agg(F.bitmap_bit_position("user_number")).alias("_users")
    )
    # Every set keeps the week and the bitmap's number.
    sets = [
        [F.col("week"), F.col("_bitmap"), *[F.col(d) for i, d in enumerate(dims) if bits & (1 << (len(dims) - 1 - i)) == 0]]
        for bits in range(2 ** len(dims))
    ]
    merged = sets_of.groupingSets(sets, "week", "_bitmap", *dims).agg(
        F.grouping_id("week", "_bitmap", *dims).cast("bigint").alias("grouping_bits"),
        F.sum("_generated").alias("_generated"),
        F.sum("_accepted").alias("_accepted"),
        F.bitmap_count(F.bitmap_or_agg("_users")).alias("_n"),
    )
    return merged.groupBy("week", *dims, "grouping_bits").agg(
        F.sum("_generated").alias("generated"), F.sum("_accepted").alias("accepted"), F.sum("_n").alias("engaged_users")
    )


def integration_rate(commits: DataFrame) -> DataFrame:
    """Per tool: distinct AI-tagged commits and their percent of all distinct commits.

    One pass over distinct (commit, tool): every commit also stands once without a tool, and those rows are the total.
    """
    tools = F.concat(F.array(F.struct(F.lit(True).alias("all"), F.lit(None).cast("string").alias("tool"))), F.transform(
        F.coalesce("ai_tool", F.array().cast("array<string>")), lambda x: F.struct(F.lit(False).alias("all"), x.alias("tool"))
    ))
    counted = commits.filter(F.col("commit_id").isNotNull()).select("commit_id", F.inline(tools)).distinct().groupBy("all", "tool").agg(F.count("*").alias("tagged_commits"))
    # A row per tool is left: the total is handed to them.
    total = F.max(F.when(F.col("all"), F.col("tagged_commits"))).over(Window.partitionBy(F.lit(0)))
    rated = counted.withColumn("integration_percent", F.round(ratio(F.col("tagged_commits"), total, 100), 2))
    return rated.filter(~F.col("all")).select("tool", "tagged_commits", "integration_percent")


def tool_velocity(commits: DataFrame) -> DataFrame:
    """Per tool: mean hours from the first commit of a pull request to its creation.

    Pull requests opened before their first commit count with negative hours, and are also counted apart.
    """
    firsts = (
        commits.select("pr_id", "pr_created_datetime", "commit_timestamp", F.explode("ai_tool").alias("tool"))
        .groupBy("tool", "pr_id", "pr_created_datetime")
        .agg(F.min("commit_timestamp").alias("first_commit"))
    )
    spent = seconds_between("first_commit", "pr_created_datetime")
    return firsts.groupBy("tool").agg(
        F.count("*").alias("pull_requests"),
        F.count_if(F.col("first_commit") > F.col("pr_created_datetime")).alias("opened_before_first_commit"),
        F.round(ratio(F.sum(spent), F.count("*") * 3600), 2).alias("mean_hours")
    )


def tool_quality(commits: DataFrame, issues: DataFrame) -> DataFrame:
    """Per tool: distinct commits and those whose tickets include a bug. Commits without tickets count in the total."""
    # Repeated bugs go once per partition, not once in all: so the join deals the bugs itself, and AQE may split the
    # commits of a frequent ticket over tasks, which it does not where an aggregate stands between exchange and join.
    bugs = issues.filter(F.col("issue_type") == "Bug").select(F.col("issue_key").alias("ticket"), F.spark_partition_id().alias("part")).distinct()
    buggy = (
        commits.select("commit_id", F.explode("commit_tickets").alias("ticket"))
        .join(bugs, "ticket", "left_semi")
        .select("commit_id")
        .distinct()
        .withColumn("is_bug", F.lit(True))
    )
    tools = commits.select("commit_id", F.explode("ai_tool").alias("tool")).distinct()
    return (
        tools.join(buggy, "commit_id", "left")
        .groupBy("tool")
        .agg(F.count("*").alias("commits"), F.count("is_bug").alias("bug_commits"))
        .withColumn("bug_percent", F.round(ratio(F.col("bug_commits"), F.col("commits"), 100), 2))
    )


def tool_security(commits: DataFrame, deploys: DataFrame, scans: DataFrame) -> DataFrame:
    """Per tool: findings of the scans of the runs that deployed its merges. A merge counts once per tool."""
    merges = commits.select(F.explode("ai_tool").alias("tool"), F.col("merge_commit_sha").alias("sha")).distinct()
    runs = deploys.filter(F.col("pipeline_commit_sha").isNotNull()).select(
        F.col("pipeline_commit_sha").alias("sha"), F.concat(F.lit("scan-"), "run_id").alias("scan_id")
    )
    return (
        merges.join(runs, "sha")
        .join(scans.select("scan_id", "total_issues"), "scan_id")
        .groupBy("tool")
        .agg(F.count("*").alias("scanned_merges"), F.sum("total_issues").alias("findings"))
    )


def engagement(usage: DataFrame, keys: Sequence[str] = ("org_name",)) -> DataFrame:
    """Active users, mean features per user and mean active days per user."""
    # Repeated uses are dropped first: two distinct counts side by side double whatever rows reach them.
    per_user = usage.select(*keys, "user_login", "feature", "usage_date").distinct().groupBy(*keys, "user_login").agg(
        F.count_distinct("feature").alias("features"), F.count_distinct("usage_date").alias("days")
    )
    n = F.count("*")
    return per_user.groupBy(*keys).agg(
        n.alias("active_users"),
        F.round(ratio(F.sum("features"), n), 2).alias("features_per_user"),
        F.round(ratio(F.sum("days"), n), 2).alias("active_days_per_user"),
    )


def trailing_users(
    usage: DataFrame, widths: Mapping[str, int], start: str, end: str, keys: Sequence[str] = ("org_name",)
) -> DataFrame:
    """Distinct users of the trailing n days, for each day of a range and each named width.

    An active day keeps its user counted from that day until the window runs out or the user's next active day takes
    over. Those spans do not overlap, so each adds +1 at its start and -1 after its end, and a running sum over days
    gives the distinct count. Nothing is multiplied by the width of the window.
    """
    longest = max(widths.values())
    days = (
        usage.filter(F.col("usage_date").between(F.date_sub(day(start), longest - 1), day(end)))
        .select(*keys, "user_login", "usage_date")
        .distinct()
    )
    following = F.lead("usage_date").over(Window.partitionBy(*keys, "user_login").orderBy("usage_date"))
    names = F.array(*[F.struct(F.lit(n).alias("width_name"), F.lit(w).alias("width")) for n, w in widths.items()])
    spans = (
        days.withColumn("_next", following)
        .select(*keys, "usage_date", "_next", F.inline(names))
        .withColumn("_stop", F.least(F.expr("date_add(usage_date, width)"), F.coalesce("_next", F.expr("date_add(usage_date, width)"))))
        .filter(F.col("_stop") > day(start))
    )
    marks = F.array(
        F.struct(F.greatest(F.col("usage_date"), day(start)).alias("usage_date"), F.lit(1).alias("delta")),
        F.struct(F.col("_stop").alias("usage_date"), F.lit(-1).alias("delta")),
    )
    # Every key of the whole input has a mark, so that those without activity in the range show as 0.
    quiet = usage.select(*keys).distinct().select(*keys, F.inline(names), day(start).alias("usage_date"), F.lit(0).alias("delta"))
    marked = spans.select(*keys, "width_name", F.inline(marks)).unionByName(quiet.drop("width"))
    deltas = marked.groupBy(*keys, "width_name", "usage_date").agg(
        F.sum("delta").alias("delta")
    )
    named = [*keys, "width_name"]
    counted = running_total(deltas, named, "usage_date", "delta", "users")
    daily = spread_to_next(counted, named, "usage_date", day(start), day(end), "_day")
    users = F.when(F.col("_day") >= F.col("usage_date"), F.col("users")).otherwise(0)
    return daily.groupBy(*keys, F.col("_day").alias("usage_date")).agg(
        *[F.coalesce(F.max(F.when(F.col("width_name") == n, users)), F.lit(0)).cast("bigint").alias(n) for n in widths]
    )


def weekly_users(usage: DataFrame) -> DataFrame:
    """Monday snapshot: one row per user and week."""
    return usage.select(F.trunc("usage_date", "week").alias("week"), "org_name", "tool", "user_login").distinct()


def sample_n(df: DataFrame, n: int, key: str, per: Sequence[str] = ()) -> DataFrame:
    """A stable subset of n rows per group, chosen by the md5 of the key: the same rows on every run."""
    order = [F.md5(F.col(key).cast("string")), F.col(key)]
    if not per:
        return df.orderBy(*order).limit(n)
    return top_rows(df, per, order, n, "_at").drop("_at")
