"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowgauge.session import scratch_path

# Word characters: everything but the six ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"


NO_ID = -(1 << 63)  # stands for a null id inside operators: the least of all


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder the session names in spark.checkpoint.dir.

    Only a local session without that setting, as in tests, gets a temporary folder.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="flowgauge-checkpoint-")
        sc.setCheckpointDir(shared)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write the rows as Parquet under the shared checkpoint folder and read them back: lineage is cut, columns are packed."""
    spark = df.sparkSession
    path = scratch_path(spark, "rows.parquet")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, keys: list[str], order: list[Column], number: str, sums: dict[str, str]) -> DataFrame:
    """Number all rows from 0 in a total order over ``keys``, with running sums of what stands before each row.

    Rows are dealt by range; windows see one range each, and what lies before a range comes from a summary with one row
    per range. So a relation of any length is numbered without passing through one task.
    """
    part = checkpointed(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    summary = part.groupBy("_range").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{a}") for a, c in sums.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    heads = summary.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *[F.coalesce(F.sum(f"_sum_{a}").over(before), F.lit(0)).alias(f"_sum_{a}") for a in sums],
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = part.withColumns(
        {number: F.row_number().over(inside) - 1} | {a: F.coalesce(F.sum(c).over(so_far), F.lit(0)) for a, c in sums.items()}
    ).join(heads, "_range")
    return rows.withColumns({number: F.col(number) + F.col("_n")} | {a: F.col(a) + F.col(f"_sum_{a}") for a in sums}).drop(
        "_range", "_n", *[f"_sum_{a}" for a in sums]
    )


def spread_join(rows: DataFrame, facts: DataFrame, keys: list[str], n: str, by: list[str] | None = None, parts: int = 1000, least_heavy: int = 256) -> DataFrame:
    """``rows`` joined to ``facts``, which has one row per key and in ``n`` the number of ``rows`` with it.

    A key with over 1/``parts`` of all rows is heavy; there are fewer than ``parts`` such keys, whatever the data, so
    the list of them can be broadcast. The rows of a heavy key are dealt over as many salts as they are times too many,
    by a hash of the columns ``by`` (all, if not given), and its fact is repeated for each, so no task reads more than a
    small share of the rows. ``facts`` is read three times; hand it in as a stored table.
    """
    total, most = facts.agg(F.sum(n), F.max(n)).first()
    limit = max((total or 0) // parts, least_heavy)
    if (most or 0) <= limit:
        return rows.join(facts, keys)
    salts = F.ceil(F.col(n) / limit).cast("int")
    heavy = facts.filter(F.col(n) > limit).select(*[F.col(k).alias(f"_k_{k}") for k in keys], salts.alias("_salts"))
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    dealt = rows.join(F.broadcast(heavy), on, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*(by or rows.columns)), F.col("_salts")).cast("int"), F.lit(0)))
    spread = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.drop("_salts", *[f"_k_{k}" for k in keys]).join(spread, [*keys, "_salt"]).drop("_salt")
