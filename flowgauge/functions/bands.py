"""Maturity bands of the five delivery metrics, and survey scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowgauge.functions.columns import col

# Industry thresholds, best band first.
# Deployments per month (at least), lead and cycle time in days, failure rate in percent,
# time to restore in hours (at most).
AT_LEAST = {"df": ((30, "elite"), (10, "high"), (3, "medium"))}
AT_MOST = {
    "ltfc": ((1, "elite"), (7, "high"), (30, "medium")),
    "ctfc": ((1, "elite"), (7, "high"), (30, "medium")),
    "cfr": ((15, "elite"), (30, "high"), (45, "medium")),
    "mttr": ((1, "elite"), (24, "high"), (168, "medium")),
}


def band(metric: str, value: str | Column) -> Column:
    """elite, high, medium or low; NULL when there is no value."""
    v = col(value)
    steps, reached = (
        (AT_LEAST[metric], lambda bound: v >= bound)
        if metric in AT_LEAST
        else (AT_MOST[metric], lambda bound: v <= bound)
    )
    out = F.lit("low")
    for bound, name in reversed(steps):
        out = F.when(reached(bound), F.lit(name)).otherwise(out)
    return F.when(v.isNotNull(), out)


def answer_score(answer: str | Column) -> Column:
    """Yes 100, No 0, 1 to 5 in steps of 25, anything else 0."""
    a = col(answer)
    n = a.try_cast("int")
    return F.when(a == "Yes", 100).when(a == "No", 0).when(n.between(1, 5), (n - 1) * 25).otherwise(0)
