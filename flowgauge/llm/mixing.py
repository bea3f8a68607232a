"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import NO_ID, checkpointed, in_order, word_count

WEIGHTS = (5.0, 2.0, 1.0)
ITEM = "doc long, source string, size long, rows long, copies double, bucket long, final boolean"


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target from one row per source (source, source_size).

    Sources weigh ``weights`` in turn by code point, null last. They share ``share`` of all sizes by weight; a target stops
    at ``most`` times its source's size, and what is over is shared again until none is above. The level at which the
    sources below it are full is found from running sums over the sources in order of size per weight.
    """
    ranked = in_order(sizes, ["source"], [F.col("source").asc_nulls_last()], "_rank", {})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    limited = ranked.withColumn("_w", weight).withColumns({"_cap": most * F.col("source_size"), "_per": most * F.col("source_size") / F.col("_w")})
    filled = in_order(limited, ["_per", "_rank"], [F.col("_per"), F.col("_rank")], "_at", {"_caps": "_cap", "_ws": "_w"})
    totals = filled.agg(F.sum("source_size").alias("size"), F.sum("_w").alias("w")).first()
    level = (F.lit(share * (totals["size"] or 0)) - F.col("_caps")) / (F.lit(totals["w"] or 0.0) - F.col("_ws"))
    # Once a source stays under its limit, all later ones do, at levels that only fall: the first one's is the greatest.
    least = filled.select(F.max(F.when(level <= F.col("_per"), level))).first()[0]
    goal = F.col("_cap") if least is None else F.least(F.col("_cap"), F.col("_w") * F.lit(least))
    return filled.select("source", "source_size", goal.alias("target"))


def uniform(key: np.ndarray, other: np.ndarray, seed: int) -> np.ndarray:
    """Repeatable numbers in [0, 1) from two ids each."""
    x = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ other.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(11)) / 2.0**53


def settle(ids: np.ndarray, size: np.ndarray, copies: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Round fractional copies pair by pair. A duel of two moves words from one to the other, at random which way with
    odds that keep each one's expected copies, until one of them is integral; the other meets the next. Gives the copies
    and the place of the only one left fractional, or -1."""
    out = copies.copy()
    draws = uniform(ids, np.roll(ids, 1), seed)
    fraction = out - np.floor(out)
    open_at = -1
    for i in np.flatnonzero((fraction > 1e-9) & (fraction < 1 - 1e-9)):
        if open_at < 0:
            open_at = i
            continue
        a, b = open_at, i
        low_a, low_b = np.floor(out[a]), np.floor(out[b])
        # Words that can go from b to a, and from a to b, before one of the two is integral.
        up = min((low_a + 1 - out[a]) * size[a], (out[b] - low_b) * size[b])
        down = min((out[a] - low_a) * size[a], (low_b + 1 - out[b]) * size[b])
        moved = up if draws[i] * (up + down) < down else -down
        out[a] += moved / size[a]
        out[b] -= moved / size[b]
        whole = [x for x in (a, b) if abs(out[x] - round(out[x])) <= 1e-9]
        for x in whole:
            out[x] = round(out[x])
        left = [x for x in (a, b) if x not in whole]
        open_at = left[0] if left else -1
    return out, open_at


def rounded(items: DataFrame, fanout: int = 16, seed: int = 17) -> DataFrame:
    """Items with whole copies. ``items``: doc, source, size, rows, copies, bucket.

    Each (source, bucket) settles its own items and leaves at most one open; the open ones of ``fanout`` neighbouring
    buckets meet in the next round, up a tree, until each source has at most one, which is rounded to the nearest.
    Items meet from the largest down, so that what stays open at the end is small. A hot
    source is many buckets, so no task holds more than a bucket, and later rounds hold one row per bucket.
    """

    def group(last: bool):
        def run(g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values(["size", "doc"], ascending=False, kind="stable").reset_index(drop=True)
            ids, words = g["doc"].to_numpy(np.int64), g["size"].to_numpy(float) * g["rows"].to_numpy(float)
            copies, left = settle(ids, words, g["copies"].to_numpy(float), seed)
            if left >= 0 and last:
                copies[left], left = np.round(copies[left]), -1
            g["copies"] = copies
            g["final"] = np.arange(len(g)) != left
            return g

        return run

    buckets = items.agg(F.max("bucket")).first()[0]
    done = None
    open_items = items.withColumn("final", F.lit(False))
    last = False
    while not last:
        last = buckets is None or buckets == 0
        step = checkpointed(open_items.groupBy("source", "bucket").applyInPandas(group(last), ITEM))
        settled = step.filter("final")
        done = settled if done is None else done.unionByName(settled)
        open_items = step.filter(~F.col("final")).withColumn("bucket", F.floor(F.col("bucket") / fanout).cast("long"))
        buckets = (buckets or 0) // fanout if not last else 0
    return done


def plan_mix(
    docs: DataFrame,
    size: Column,
    weights: Sequence[float] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    per_bucket: int = 4096,
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """One row per (doc, source, size): source_size, target and the whole number of ``copies`` of each of its rows.

    Every document of a source has the same expected copies, target / source_size. Dependent rounding keeps a source's
    taken words at its target but for at most half a document. The result does not depend on how rows are partitioned, and reruns agree.
    Rows that agree in id, source and size are one item and share their copies. Documents of size 0 are taken as
    often as their expected copies round down to. Null ids and sources are values of their own.
    """
    sized = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID).cast("long")).alias("doc"), F.col(source).cast("string").alias("source"), size.alias("size")
    )
    items = checkpointed(sized.groupBy("doc", "source", "size").agg(F.count("*").alias("rows")))
    per_source = checkpointed(items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("n")))
    goal = targets(per_source, weights, share, most)
    aimed = checkpointed(goal.join(per_source.drop("source_size").withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    aimed = aimed.withColumnRenamed("source", "_source")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ready = items.join(aimed, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc",
        "source",
        "size",
        "rows",
        F.when(F.col("size") > 0, copies).otherwise(F.floor(copies).cast("double")).alias("copies"),
        F.pmod(F.xxhash64("doc", "size"), F.ceil(F.col("n") / per_bucket).cast("long")).alias("bucket"),
    )
    taken = rounded(ready).select("doc", "source", "size", "rows", F.round("copies").cast("long").alias("copies"))
    return taken.join(aimed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "n")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """One row per document: doc_id, source, size in words, source_size, target, and the whole ``copies`` that the mix takes.

    Null texts have size 0. Everything else is said at ``plan_mix``. No rows give no rows; other columns are not read.
    """
    plan = plan_mix(docs, word_count(F.col(text)), doc_id=doc_id, source=source, **how)
    each = plan.withColumn("_row", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))))
    return each.select(F.nullif(F.col("doc"), F.lit(NO_ID).cast("long")).alias("doc_id"), "source", "size", "source_size", "target", "copies")


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself: every row of ``docs``, with its columns, whatever their names, as often as it is taken."""
    plan = plan_mix(docs, word_count(F.col(text)), doc_id=doc_id, source=source, **how).filter("copies > 0")
    key = [F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID).cast("long")).alias("doc"), word_count(F.col(text)).alias("size")]
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *key, F.col(source).cast("string").alias("of"))
    on = (keyed["doc"] == plan["doc"]) & (keyed["size"] == plan["size"]) & keyed["of"].eqNullSafe(plan["source"])
    times = F.explode(F.array_repeat(F.lit(0), plan["copies"].cast("int")))
    return keyed.join(plan, on).select("row", times.alias("copy")).select("row.*")
