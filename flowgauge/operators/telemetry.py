"""Platform telemetry: slots, memory, activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.columns import period_start, ratio


def slot_utilisation(instances: DataFrame, nodes: DataFrame, grain: str, keys: Sequence[str] = ("environment",)) -> DataFrame:
    """Reserved over maximum slots of the instances that reported a node that day, as a ratio of sums, and the headroom.

    Node reports are reduced to distinct (day, instance) before the join; an instance that was silent does not count.
    """
    seen = nodes.select(F.to_date("create_time").alias("day"), "instance_id").distinct()
    joined = seen.join(instances.select("instance_id", "max_slots", "reserved_slots", *keys), "instance_id")
    reserved, maximum = F.sum("reserved_slots"), F.sum("max_slots")
    return joined.groupBy(period_start("day", grain).alias("period"), *keys).agg(
        reserved.alias("reserved_slots"),
        maximum.alias("max_slots"),
        F.round(ratio(reserved, maximum, 100), 2).alias("slot_utilisation_percent"),
        (maximum - reserved).alias("capacity_headroom"),
    )


def memory_and_cores(instances: DataFrame, nodes: DataFrame, grain: str) -> DataFrame:
    """JVM share of memory and CPU cores per period and environment. Nodes are summed per instance before the join."""
    per_instance = nodes.groupBy("instance_id", period_start("create_time", grain).alias("period")).agg(
        F.sum("jvm_max_mem_gb").alias("jvm"), F.sum("total_memory_gb").alias("memory"), F.sum("cpu_cores").alias("cores")
    )
    return (
        per_instance.join(instances.select("instance_id", "environment"), "instance_id")
        .groupBy("period", "environment")
        .agg(
            F.round(ratio(F.sum("jvm"), F.sum("memory"), 100), 2).alias("jvm_memory_percent"),
            F.sum("cores").alias("cpu_cores"),
        )
    )


def activity_by_type(activities: DataFrame) -> DataFrame:
    return activities.groupBy("event_type", "by_whom").agg(F.count("*").alias("n"))


def users_by_first_week(activities: DataFrame) -> DataFrame:
    """New users per Monday week of their first event."""
    firsts = activities.groupBy("by_whom").agg(F.min("create_time").alias("first_seen"))
    return firsts.groupBy(period_start("first_seen", "week").alias("week")).agg(F.count("*").alias("new_users"))


def instance_counts(instances: DataFrame, by: str, k: int | None = None) -> DataFrame:
    """Distinct values of a column by number of instances, most first."""
    out = instances.groupBy(by).agg(F.count("*").alias("instances")).orderBy(F.desc("instances"), by)
    return out if k is None else out.limit(k)
