"""Reading, writing and rewriting tables. Rewrites go to a new path: a path that is being read is never overwritten."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.operators.ordering import position_in_key, top_rows
from flowgauge.schemas import RAW


def read_table(spark: SparkSession, folder: str, name: str, n: int | None = None) -> DataFrame:
    """A named parquet table with its declared schema, optionally a bounded peek at it."""
    df = spark.read.schema(RAW[name]).parquet(f"{folder}/{name}.parquet")
    return df if n is None else df.limit(n)


def literal_rel(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A relation written out in code, such as a dictionary. Spark knows its size and joins it accordingly."""
    return spark.createDataFrame(list(rows), schema)


def append(df: DataFrame, path: str) -> DataFrame:
    """Append to a parquet folder in one columnar write, and return the folder's rows."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus one source row for each key that it does not have yet: the least, by its columns in order."""
    order = [F.col(c) for c in source.columns]
    return target.unionByName(top_rows(source, keys, order, 1, "_rank").drop("_rank").join(target.select(*keys).distinct(), list(keys), "left_anti"))


def keep_after_delete(df: DataFrame, scope: Column) -> DataFrame:
    """Rows that a scoped delete leaves. A row whose scope is unknown (NULL) stays."""
    return df.filter(~F.coalesce(scope, F.lit(False)))


def delete_counts(df: DataFrame, scope: Column) -> DataFrame:
    """One row: how many rows the delete removes and how many remain."""
    hit = F.coalesce(scope, F.lit(False))
    return df.agg(F.count_if(hit).alias("deleted"), F.count_if(~hit).alias("remaining"))


def replace_scope(old: DataFrame, new: DataFrame, scope: Column) -> DataFrame:
    """Idempotent re-seed: the scope's old rows go, the new rows come. Running it twice gives the same table."""
    return keep_after_delete(old, scope).unionByName(new)


def owned_by(org: str, tools: Sequence[str], org_col: str = "org_name", tool_col: str = "tool") -> Column:
    """Scope of one owner in a table that several share: its organisation and only its tools."""
    return (F.col(org_col) == org) & F.col(tool_col).isin(list(tools))


def update_where(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true. All right-hand sides see the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, e).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, e in changes.items()})


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns that are not there yet; old rows get a typed NULL."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns})


def preview_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table, in one job."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def export_scope(df: DataFrame, path: str, scope: str) -> None:
    """Snapshot a table as one folder per scope value.

    Rows are rebalanced by scope: small scopes share a task, and Spark splits a large one over as many writers as its
    size needs.
    """
    df.hint("rebalance", F.col(scope)).write.partitionBy(scope).mode("errorifexists").parquet(path)


def restore_scope(spark: SparkSession, path: str, schema: str, scope: str, values: Sequence[str]) -> DataFrame:
    """Read back the snapshot of some scope values. Only their folders are listed and scanned."""
    return spark.read.schema(schema).parquet(path).filter(F.col(scope).isin(list(values)))


def seats_view(seats: DataFrame, org_map: DataFrame, cleansed_orgs: Sequence[str] = (), words: str = "corp|_|-|@") -> DataFrame:
    """Seats per linked organisation: activity text as timestamp, date and hour, and logins cleansed per tenant.

    An organisation with no linked organisation gives no rows.
    """
    at = F.col("last_activity_at").try_cast("timestamp_ntz")
    linked = org_map.select("org_name", F.explode("linked_org_name").alias("linked_org"))
    tenant = F.col("linked_org").isin(list(cleansed_orgs))
    return seats.join(linked, "org_name").select(
        at.alias("usage_datetime"),
        at.cast("date").alias("usage_date"),
        F.hour(at).alias("usage_hour"),
        F.col("linked_org").alias("org_name"),
        "org_assignee_login",
        F.when(tenant, F.regexp_replace(F.trim(F.lower("org_assignee_login")), words, ""))
        .otherwise(F.col("org_assignee_login"))
        .alias("cleansed_org_assignee_login"),
        F.when(tenant, F.col("org_assignee_login")).otherwise(F.col("assignee_login")).alias("cleansed_assignee_login"),
        "created_at",
    )


def pack_json(df: DataFrame, keys: Sequence[str], columns: Sequence[str], alias: str, per_row: int = 1000) -> DataFrame:
    """JSON objects packed into arrays per key, about ``per_row`` to an array.

    A key with more objects gets several rows, told apart by ``part``, so that no key is ever collected whole. Objects are
    numbered inside their key, so equal objects are spread like others.
    """
    hashed = df.withColumn("_hash", F.pmod(F.xxhash64(*columns), F.lit(64)))
    placed = position_in_key(hashed, keys, ["_hash", *columns], "_at", F.col("_hash"))
    rows = placed.withColumn("part", F.floor(F.col("_at") / F.lit(per_row)).cast("bigint"))
    packed = rows.groupBy(*keys, "part").agg(F.collect_list(F.to_json(F.struct(*columns))).alias(alias))
    return packed


