"""Latest rows, neighbours and running totals that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str = "rank_in_key") -> DataFrame:
    """The first k rows per key in a total order, with their position.

    The filter sits on the row number, so Spark cuts every map partition to k rows per key before the shuffle; a hot
    key never reaches one task whole.
    """
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col(rank) <= k)


def latest_record(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given total order."""
    return top_rows(df, keys, order, 1, "_rank").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """All rows that carry the newest stamp of their own key (ties kept). NULL is a key like any other.

    The newest stamp is taken per key: a newer snapshot of one key must not hide the others. It is an aggregate joined
    back, not a window, so a snapshot of any size stays spread over its tasks.
    """
    newest = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(stamp).alias("_newest"))
    on = F.col(stamp) == F.col("_newest")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(newest, on, "left_semi")


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, alias: str, bucket: Column
) -> DataFrame:
    """The value of the previous row of the same key, in ascending order of the order columns.

    ``bucket`` is a coarse, order-preserving part of the first order column, such as its day. Rows are ordered inside
    (key, bucket) only. What crosses a bucket's start comes from a summary with one row per key and bucket, which takes
    part in the window as the bucket's first row.
    """
    rows = df.withColumns({"_bucket": bucket, "_value": F.col(value), "_real": F.lit(True)})
    lasts = rows.groupBy(*keys, "_bucket").agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    carried = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket"))
    heads = lasts.select(*keys, "_bucket", carried.alias("_value"), F.lit(False).alias("_real"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_real", *order)
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn(alias, F.lag("_value").over(inside))
    return both.filter("_real").drop("_bucket", "_value", "_real")


def running_total(df: DataFrame, keys: Sequence[str], day: str, value: str, alias: str) -> DataFrame:
    """Running sum per key over a relation that already has one row per key and day."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(alias, F.sum(value).over(w))


def position_in_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], alias: str, bucket: Column) -> DataFrame:
    """0-based position of each row inside its key, ascending by the order columns, with the key's row count.

    ``bucket`` is a coarse, order-preserving part of the first order column. Rows are numbered inside (key, bucket) only;
    offset and count come from a summary with one row per key and bucket, which joins the window as its first row.
    """
    rows = df.withColumns({"_bucket": bucket, "_real": F.lit(True)})
    sizes = rows.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = sizes.select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias(f"{alias}_count"),
        F.lit(False).alias("_real"),
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_real", *order)
    numbered = rows.unionByName(heads, allowMissingColumns=True).withColumns(
        {
            # The summary row is number 1, so the first real row is number 2 and has position 0.
            "_row": F.row_number().over(inside) - 2,
            "_offset": F.first("_offset").over(inside),
            f"{alias}_count": F.first(f"{alias}_count").over(inside),
        }
    )
    return numbered.filter("_real").withColumn(alias, F.col("_offset") + F.col("_row")).drop("_bucket", "_real", "_row", "_offset")


def spread_to_next(df: DataFrame, keys: Sequence[str], at: str, start: Column, end: Column, alias: str) -> DataFrame:
    """Every day of a range for each key that has a row in it: a row covers the days up to the key's next row.

    The first row also covers the days before it; compare ``alias`` with ``at`` to tell them. The input has at most one
    row per key and day, and is read once: there is no calendar to join.
    """
    in_key = Window.partitionBy(*keys).orderBy(at)
    begins = F.when(F.row_number().over(in_key) == 1, start).otherwise(F.col(at))
    ends = F.coalesce(F.date_sub(F.lead(at).over(in_key), 1), end)
    inside = df.filter(F.col(at).between(start, end)).withColumns({"_begins": begins, "_ends": ends})
    return inside.withColumn(alias, F.explode(F.sequence("_begins", "_ends"))).drop("_begins", "_ends")


def carried_value(rows: DataFrame, steps: DataFrame, keys: Sequence[str], at: str, step_at: str, value: str, bucket: Callable[[Column], Column]) -> DataFrame:
    """``rows`` with the value of the last step of their key at or before ``at``; NULL before the first.

    Steps and rows are stacked and the last value is carried forward inside (key, bucket) only, ``bucket`` being a
    coarse, order-preserving part of the time, such as its month. What crosses a bucket's start comes from a summary with
    one row per key and bucket that occurs. There is no row per key and day, however far apart the times are.
    """
    facts = rows.withColumns({"_at": F.col(at), "_kind": F.lit(2), "_step": F.lit(None).cast(steps.schema[value].dataType)})
    marks = steps.select(*keys, F.col(step_at).alias("_at"), F.lit(1).alias("_kind"), F.col(value).alias("_step"))
    both = facts.unionByName(marks, allowMissingColumns=True).withColumn("_bucket", bucket(F.col("_at")))
    last_step = F.max(F.when(F.col("_kind") == 1, F.struct("_at", "_step")))
    summary = both.groupBy(*keys, "_bucket").agg(last_step["_step"].alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = summary.select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_step"), F.lit(0).alias("_kind"))
    # A bucket's summary row has no time and stands first.
    inside = Window.partitionBy(*keys, "_bucket").orderBy(F.col("_at").asc_nulls_first(), "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.unionByName(heads, allowMissingColumns=True).withColumn(value, F.last("_step", ignorenulls=True).over(inside))
    return carried.filter("_kind = 2").select(*rows.columns, value)


def refined_bucket(df: DataFrame, keys: Sequence[str], bucket: Column, by: Sequence[str], alias: str, most: int = 100_000, levels: int = 1) -> DataFrame:
    """``df`` with an order-preserving bucket of bounded size: ``bucket``, cut further by ranges of whole numbers.

    ``by`` are the order columns inside a bucket. The rows of every (key, bucket) are counted; one with over ``most`` rows
    is cut into equal ranges of the first of ``by`` that varies in it, four times as many as it is too large. Each
    further level does the same with the ranges that are still too large. Buckets with less than a ten-thousandth of all
    rows are left whole, so there are fewer than 10,000 to cut, whatever the data: a relation that Spark
    broadcasts by its measured size.
    """
    parts = [alias]
    out = df.withColumn(alias, bucket)
    for level in range(levels):
        ends = [f(c).alias(f"_{n}{i}") for i, c in enumerate(by) for f, n in ((F.min, "low"), (F.max, "high"))]
        sizes = out.groupBy(*keys, *parts).agg(F.count("*").alias("_n"), *ends)
        large = sizes.filter((F.col("_n") > most) & (F.col("_n") > sizes.select(F.sum("_n") / 10_000).scalar()))
        names = {c: f"_b{i}" for i, c in enumerate([*keys, *parts])}
        pieces = 4 * F.ceil(F.col("_n") / most)
        widths = [F.greatest(F.lit(1), F.ceil((F.col(f"_high{i}") - F.col(f"_low{i}") + 1) / pieces)).alias(f"_width{i}") for i in range(len(by))]
        varies = [(F.col(f"_high{i}") > F.col(f"_low{i}")).alias(f"_varies{i}") for i in range(len(by))]
        extra = [f"_{n}{i}" for i in range(len(by)) for n in ("low", "width", "varies")]
        cuts = large.select(*[F.col(c).alias(n) for c, n in names.items()], *[F.col(f"_low{i}") for i in range(len(by))], *widths, *varies)
        on = F.lit(True)
        for c, n in names.items():
            on = on & F.col(c).eqNullSafe(F.col(n))
        cut = F.lit(0).cast("long")
        for i in reversed(range(len(by))):
            cut = F.when(F.col(f"_varies{i}"), F.floor((F.col(by[i]) - F.col(f"_low{i}")) / F.col(f"_width{i}"))).otherwise(cut)
        part = f"{alias}_{level}"
        out = out.join(cuts, on, "left").withColumn(part, cut.cast("long")).drop(*names.values(), *extra)
        parts.append(part)
    return out.withColumn(alias, F.struct(*parts)).drop(*parts[1:])


def exact_median(counted: DataFrame, keys: Sequence[str], value: str, n: str, alias: str, ranges: int = 1 << 15, levels: int = 2) -> DataFrame:
    """The median per key of whole numbers, each with its count ``n``; NULL values do not count.

    Rank selection: a key's span is cut into ``ranges``, rows are counted per range, and only the ranges that hold the
    two middle ranks are looked at again, cut into as many. After two levels a range is a 2^30th of the span, most often one
    value; what is left of it is ranked. No task ever holds a key's values: windows see the counts of its ranges.
    """
    known = counted.filter(F.col(value).isNotNull())
    total = F.sum(n)
    ends = known.groupBy(*keys).agg(total.alias("_total"), F.min(value).alias("_low"), F.max(value).alias("_high"))
    middle = F.array_distinct(F.array(F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)))
    wanted = ends.select(*keys, F.explode(middle).alias("_rank"), "_low", "_high", F.lit(0).cast("long").alias("_before"))
    so_far = Window.partitionBy(*keys, "_rank").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)

    def holding(parts: DataFrame) -> DataFrame:
        """Of the counted parts of each wanted rank the one that holds it."""
        placed = parts.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(so_far), F.lit(0)))
        return placed.filter((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))

    def inside() -> DataFrame:
        return known.join(wanted, list(keys)).filter(F.col(value).between(F.col("_low"), F.col("_high")))

    for _ in range(levels):
        width = F.ceil((F.col("_high") - F.col("_low") + 1) / ranges)
        part = F.floor((F.col(value) - F.col("_low")) / width)
        counts = inside().groupBy(*keys, "_rank", "_before", part.alias("_from")).agg(total.alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"))
        wanted = holding(counts).select(*keys, "_rank", "_low", "_high", "_before")
    last = holding(inside().select(*keys, "_rank", "_before", F.col(value).alias("_from"), F.col(n).alias("_n")))
    return last.groupBy(*keys).agg(F.avg("_from").alias(alias))
