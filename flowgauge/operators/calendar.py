"""Calendars and event windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.functions.columns import col, is_weekday, year_month


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def spine_of(df: DataFrame, at: str, step: str = "INTERVAL 1 DAY", alias: str = "day") -> DataFrame:
    """Every day (or week, month) between the first and the last date of a relation."""
    lo, hi = F.min(F.to_date(at)), F.max(F.to_date(at))
    return df.agg(lo.alias("lo"), hi.alias("hi")).select(F.explode(F.sequence("lo", "hi", F.expr(step))).alias(alias))


def day_type(at: str | Column, holidays: Sequence[str] = (), shutdowns: Sequence[tuple[str, str]] = ()) -> Column:
    """shutdown, holiday, weekend or normal; the first that applies."""
    d = col(at).cast("date")
    out = F.when(F.lit(False), "")
    for a, b in shutdowns:
        out = out.when(d.between(day(a), day(b)), "shutdown")
    if holidays:
        out = out.when(d.isin([day(h) for h in holidays]), "holiday")
    return out.when(~is_weekday(d), "weekend").otherwise("normal")


def in_window(at: str | Column, window: tuple[int, int], anchor: str) -> Column:
    """True when the day lies in a window given as days before the anchor (first, last)."""
    early, late = max(window), min(window)
    d = col(at).cast("date")
    return d.between(F.date_sub(day(anchor), early), F.date_sub(day(anchor), late))


def tag_windows(df: DataFrame, at: str, windows: Mapping[str, tuple[int, int]], anchor: str) -> DataFrame:
    """One row per row and named window it falls in; rows outside all windows are dropped.

    The windows are a few literals, so this is a filter on the row itself and not a range join.
    """
    names = F.array_compact(F.array(*[F.when(in_window(at, w, anchor), F.lit(n)) for n, w in windows.items()]))
    return df.withColumn("window_name", F.explode(names))


def business_day_picks(days: DataFrame, n: int, at: str = "day") -> DataFrame:
    """Business days of each month, with their number and whether they are among n evenly spaced picks.

    The input has one row per day, so a month is at most 31 rows.
    """
    month = Window.partitionBy("month")
    rows = (
        days.filter(is_weekday(at))
        .withColumn("month", F.trunc(at, "month"))
        .withColumn("_i", F.row_number().over(month.orderBy(at)) - 1)
        .withColumn("business_days", F.count("*").over(month))
        .withColumn("_n", F.least(F.lit(n), F.col("business_days")))
    )
    # Pick j sits at floor(j * days / n); a day is picked if the j next to it lands on it.
    j = F.ceil(F.col("_i") * F.col("_n") / F.col("business_days"))
    picked = (j < F.col("_n")) & (F.floor(j * F.col("business_days") / F.col("_n")) == F.col("_i"))
    return rows.withColumn("picked", picked).drop("_i", "_n")


def week_day(at: str | Column, number: int) -> Column:
    """The given weekday (0 Monday to 6 Sunday) in the Monday week of a day."""
    return F.date_add(F.trunc(col(at).cast("date"), "week"), number)


def last_weekday_before(at: str | Column) -> Column:
    """The last Monday-to-Friday strictly before a day."""
    d = col(at).cast("date")
    w = F.weekday(d)
    return F.date_sub(d, F.when(w == 0, 3).when(w == 6, 2).otherwise(1))


def sprint_windows(bounds: DataFrame, as_of: str, length: int = 14) -> DataFrame:
    """Sprints from the first Monday on or after ``lo`` until ``hi``; the last one is cut, and each is closed or active.

    ``bounds`` is one row with lo and hi.
    """
    first = F.date_add(F.col("lo"), F.pmod(F.lit(7) - F.weekday("lo"), F.lit(7)))
    starts = F.sequence(first, F.date_sub(F.col("hi"), 1), F.expr(f"INTERVAL {length} DAY"))
    rows = bounds.filter(first < F.col("hi")).select("hi", F.posexplode(starts).alias("_i", "sprint_start"))
    stop = F.least(F.date_add("sprint_start", length - 1), F.col("hi"))
    return rows.select(
        (F.col("_i") + 1).alias("sprint_number"),
        "sprint_start",
        stop.alias("sprint_end"),
        F.when(stop < day(as_of), "closed").otherwise("active").alias("sprint_state"),
    )


def month_list(df: DataFrame, at: str) -> DataFrame:
    """Every month between the first and last date of a relation, with its yyyymm key and label."""
    lo, hi = F.trunc(F.min(F.to_date(at)), "month"), F.trunc(F.max(F.to_date(at)), "month")
    months = df.agg(lo.alias("lo"), hi.alias("hi")).select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return months.select("month", year_month("month").alias("year_month"), F.date_format("month", "MMM yyyy").alias("month_name"))
