"""Column helpers shared by the operators. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seconds_of_day(ts: str | Column) -> Column:
    ts = col(ts)
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end. Works on zone-less timestamps, whatever the session zone."""
    days = F.datediff(col(end), col(start)).cast("bigint")
    return days * 86400 + seconds_of_day(end) - seconds_of_day(start)


def period_start(ts: str | Column, grain: str) -> Column:
    """First day of the day, week (Monday), month or year that holds ts."""
    day = col(ts).cast("date")
    return day if grain == "day" else F.trunc(day, grain)


def year_month(day: str | Column) -> Column:
    return F.year(col(day)) * 100 + F.month(col(day))


def month_label(day: str | Column) -> Column:
    return F.date_format(col(day), "MMM yyyy")


def week_label(monday: str | Column) -> Column:
    """``Apr W1 2025``: weeks start on Monday and are numbered inside the month of their Monday."""
    m = col(monday)
    number = F.ceil(F.dayofmonth(m) / F.lit(7)).cast("string")
    return F.concat(F.date_format(m, "MMM"), F.lit(" W"), number, F.lit(" "), F.date_format(m, "yyyy"))


def is_weekday(day: str | Column) -> Column:
    """Monday to Friday."""
    return F.weekday(col(day)) < 5


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """part / whole * scale as DOUBLE; NULL when whole is 0 or NULL. Rounding is left to the caller, once, at the end."""
    return F.try_divide(part.cast("double") * F.lit(float(scale)), whole.cast("double"))


def money(c: str | Column) -> Column:
    """Fixed-point copy of a DOUBLE, so that a sum does not depend on the order of addition."""
    return col(c).cast("decimal(18,2)")


def flag(c: str | Column) -> Column:
    """One BOOLEAN from the flag spellings in use: 'Y', 'true', TRUE, 'yes', '1'. NULL counts as false."""
    return F.coalesce(F.lower(F.trim(col(c).cast("string"))).isin("y", "yes", "true", "1"), F.lit(False))


def any_of(conditions: Sequence[Column]) -> Column:
    """OR of all conditions, as one expression that stays whole when AND-ed with others."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def like_any(c: str | Column, patterns: Sequence[str]) -> Column:
    low = F.lower(col(c))
    return F.coalesce(any_of([low.like(p) for p in patterns]), F.lit(False))


def lookup(c: str | Column, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Map a column through a small fixed dictionary, as a CASE expression (no join)."""
    c = col(c)
    out = F.lit(default).cast("string")
    for key, value in mapping.items():
        out = F.when(c == key, F.lit(value)).otherwise(out)
    return out



def short_id(length: int, *cols: str | Column) -> Column:
    """Stable short id from key parts: a prefix of their sha1."""
    return F.substring(F.sha1(F.concat_ws("|", *[col(c).cast("string") for c in cols])), 1, length)


def git_url_key(url: str | Column) -> Column:
    """Canonical repository URL: one trailing ``.git`` is dropped."""
    return F.regexp_replace(col(url), r"\.git$", "")
