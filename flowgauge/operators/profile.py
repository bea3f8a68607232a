"""Table profiles, set comparisons, funnels and token extraction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import any_of, ratio


def stack_frames(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def profile_tables(tables: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Rows, first and last date per table, in one job. A table without a date column gets NULL dates."""
    null = F.lit(None).cast("date")
    parts = []
    for name, (df, date) in tables.items():
        d = F.to_date(date) if date else null
        parts.append(df.agg(F.count("*").alias("n_rows"), F.min(d).alias("min_date"), F.max(d).alias("max_date")).withColumn("table", F.lit(name)))
    return stack_frames(parts)


def set_diff(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct keys of two tables, tagged shared, only_left or only_right. NULL keys compare equal.

    Both key sets go through one aggregate, which also drops the duplicates before the shuffle.
    """
    left = a.select(*columns, F.lit(1).alias("_side"))
    right = b.select(*columns, F.lit(2).alias("_side"))
    sides = left.unionByName(right).groupBy(*columns).agg(F.bit_or("_side").alias("_sides"))
    tag = F.when(F.col("_sides") == 3, "shared").when(F.col("_sides") == 1, "only_left").otherwise("only_right")
    return sides.select(*columns, tag.alias("side"))


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and percent (1 digit) of every column, in one pass over the table."""
    names = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_count")) for i, c in enumerate(names)])
    return counts.select("_n", F.inline(rows)).select(
        "column_name", "null_count", F.round(ratio(F.col("null_count"), F.col("_n"), 100), 1).alias("null_percent")
    )


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values; ties in value order."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column)).limit(k)


def cross_tab(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def non_null_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), *[F.count(c).alias(f"with_{c}") for c in columns])


def duplicates(df: DataFrame, keys: Sequence[str], member: str) -> DataFrame:
    """Rows of the keys that occur more than once: one row per member, with the key's number of rows.

    Members stay rows instead of one array per key, so a key of any size stays spread over tasks.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_members")).filter("n_members > 1")
    return df.select(*keys, member).join(counts, list(keys))


def matches(regex: str, columns: Sequence[str] = (), array: str | None = None) -> Column:
    """True when the joined text of the columns, or any element of the array, matches. NULLs do not match."""
    tests = []
    if columns:
        tests.append(F.concat_ws(" ", *columns).rlike(regex))
    if array:
        tests.append(F.coalesce(F.exists(array, lambda x: F.coalesce(x.rlike(regex), F.lit(False))), F.lit(False)))
    return any_of(tests)


def stage_funnel(source: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """Row count at each stage of a query, in order, from one pass over its source.

    A stage is named with the count of the rows that get to it: an aggregate over the source, such as a conditional one.
    """
    counts = source.agg(*[c.alias(f"_{i}") for i, (_, c) in enumerate(stages)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("stage"), F.col(f"_{i}").alias("n_rows")) for i, (name, _) in enumerate(stages)]
    return counts.select(F.inline(F.array(*rows)))


def combo_matrix(
    daily: DataFrame, day: str, value: str, ranges: Mapping[str, tuple[str, str]], filters: Mapping[str, Column]
) -> DataFrame:
    """Sum of a value for every combination of date range and filter, 0 where nothing matches.

    All combinations are conditional sums of one pass; nothing is multiplied by the number of combinations.
    """
    names = [(r, f) for r in ranges for f in filters]
    day_col = F.col(day)

    def total(r: str, f: str) -> Column:
        start, end = ranges[r]
        hit = day_col.between(F.lit(start).cast("date"), F.lit(end).cast("date")) & filters[f]
        return F.coalesce(F.sum(F.when(hit, F.col(value))), F.lit(0))

    sums = daily.agg(*[total(r, f).alias(f"_{i}") for i, (r, f) in enumerate(names)])
    rows = F.array(
        *[
            F.struct(F.lit(r).alias("date_range"), F.lit(f).alias("filter"), F.col(f"_{i}").alias("total"))
            for i, (r, f) in enumerate(names)
        ]
    )
    return sums.select(F.inline(rows))


def extract_tokens(df: DataFrame, columns: Sequence[str], regex: str) -> DataFrame:
    """Distinct tokens of a shape, with the column they were found in. Whole texts are searched."""
    found = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.regexp_extract_all(c, F.lit(regex), F.lit(0)).alias("_tokens")) for c in columns]
    )
    return df.select(F.inline(found)).select("column_name", F.explode("_tokens").alias("token")).distinct()


def wired(ids: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Distinct ids with a flag that tells if the other relation knows them."""
    marks = known.select(column).distinct().withColumn("_known", F.lit(True))
    return ids.select(column).distinct().join(marks, column, "left").select(column, F.coalesce("_known", F.lit(False)).alias("is_wired"))


def join_matches(a: DataFrame, b: DataFrame, left: str, right: str) -> DataFrame:
    """How many row pairs an equi join would give, and over how many keys, without building the pairs."""
    x = a.groupBy(F.col(left).alias("_k")).agg(F.count("*").alias("_x"))
    y = b.groupBy(F.col(right).alias("_k")).agg(F.count("*").alias("_y"))
    return x.join(y, "_k").agg(
        F.count("*").alias("matching_keys"), F.coalesce(F.sum(F.col("_x") * F.col("_y")), F.lit(0)).alias("matching_pairs")
    )


def first_rows(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first k rows in a total order (a top-k, never a full sort)."""
    return df.orderBy(*order).limit(k)


def enumeration(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def fill_rate(df: DataFrame, tenant: str, columns: Sequence[str]) -> DataFrame:
    """Rows and distinct tenants per category value."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows"), F.count_distinct(tenant).alias("n_tenants"))
