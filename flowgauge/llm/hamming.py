"""Exact nearest binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import checkpointed
from flowgauge.operators.ordering import top_rows


def sign_code(vector: Column, bits: int, fold: int) -> Column:
    """Bit i is 1 if the sum of components i * fold up to (i + 1) * fold is over 0. Null unless there are bits * fold
    components, all of them finite numbers."""
    values = F.transform(vector, lambda x: x.cast("double"))
    sums = [sum((F.element_at(values, i * fold + j + 1) for j in range(1, fold)), F.element_at(values, i * fold + 1)) for i in range(bits)]
    one = F.lit(1).cast("long")
    code = F.lit(0).cast("long")
    for i, s in enumerate(sums):
        code = code.bitwiseOR(F.when(s > 0, F.call_function("shiftleft", one, F.lit(i))).otherwise(F.lit(0).cast("long")))
    finite = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return F.when(vector.isNotNull() & (F.size(vector) == bits * fold) & F.coalesce(finite, F.lit(False)), code)


def nearest(index: DataFrame, queries: DataFrame, k: int = 10, bits: int = 32, segments: int | None = None) -> DataFrame:
    """query_id, rank, id, distance: each query's k nearest other rows by Hamming distance, then by id.

    ``index`` has id and code, ``queries`` query_id and code; codes are LONG with ``bits`` bits. Codes are cut into
    ``segments``; if not given, so many that a segment has about as many bits as the number of entries, which keeps the
    buckets short. The search radii of the segments grow in turn, one bit of one segment a step: step t looks up the
    values of segment t % segments at exactly t // segments bits from the queries'. A pair is verified in the first step
    that meets it, so once. A code not met so far is over t bits away, for each segment is further than its radius; so a
    query is done as soon as its kth verified distance is t or less, and only the others go on.
    No candidate is left out, and the last round covers everything.

    Equal codes are one entry with its k + 1 least ids, and equal queries are asked once, so a code that many rows
    share costs one row. Rows with a null code or id are not indexed; queries with one have no result. Repeated ids are
    one entry; a query finds all ids but its own. Fewer than k other rows give fewer results; no rows none.
    """
    rows = index.select(F.col("id"), F.col("code")).filter("id IS NOT NULL AND code IS NOT NULL").distinct()
    least = top_rows(rows, ["code"], [F.col("id")], k + 1, "_r").groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = checkpointed(least)
    if segments is None:
        fit = math.log2(max(2, entries.count()))
        segments = min((m for m in range(1, bits + 1) if bits % m == 0 and bits // m <= 32), key=lambda m: abs(bits / m - fit))
    if bits % segments:
        raise ValueError("segments must divide the bits")
    width = bits // segments
    mask = F.lit((1 << width) - 1).cast("long")

    def segment(code: Column, s: int) -> Column:
        return F.call_function("shiftright", code, F.lit(s * width)).bitwiseAND(mask)

    asked = queries.select("query_id", F.col("code").alias("q")).filter("query_id IS NOT NULL AND q IS NOT NULL").distinct()
    asked = checkpointed(asked)
    cut = entries.select("code", "ids", F.posexplode(F.array(*[segment(F.col("code"), s) for s in range(segments)])).alias("s", "value"))
    cut = checkpointed(cut)
    active, done, best = checkpointed(asked.select("q").distinct()), None, None
    last = segments * (width + 1) - 1
    for step in range(last + 1):
        r, s = divmod(step, segments)
        flips = F.array(*[F.lit(sum(1 << b for b in chosen)).cast("long") for chosen in combinations(range(width), r)])
        probes = active.select("q", F.explode(F.transform(flips, lambda m: m.bitwiseXOR(segment(F.col("q"), s)))).alias("value"))
        met = probes.join(cut.filter(F.col("s") == s).drop("s"), "value")
        # Met before, if a segment whose radius has grown already is within it, or one still to grow within the last.
        first = F.lit(True)
        for other in range(segments):
            apart = F.bit_count(segment(F.col("q"), other).bitwiseXOR(segment(F.col("code"), other)))
            first = first & (apart > r if other < s else apart >= r)
        found = met.filter(first).select("q", "ids", F.bit_count(F.col("q").bitwiseXOR(F.col("code"))).cast("long").alias("distance"))
        # Of codes at one distance, and of all codes, only k + 1 ids can be among the nearest.
        flat = found.select("q", F.explode("ids").alias("id"), "distance")
        flat = flat if best is None else flat.unionByName(best.join(active, "q"))
        best = checkpointed(top_rows(flat, ["q"], [F.col("distance"), F.col("id")], k + 1, "_r").drop("_r"))
        state = best.groupBy("q").agg(F.count("*").alias("n"), F.max("distance").alias("far"))
        over = state.filter((F.col("n") > k) & (F.col("far") <= step)).select("q")
        finished = best.join(over, "q") if step < last else best
        done = finished if done is None else done.unionByName(finished)
        active = checkpointed(active.join(over, "q", "left_anti"))
        if active.isEmpty():
            break
    pairs = asked.join(done, "q").filter(F.col("id") != F.col("query_id"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "q").orderBy("distance", "id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("long").alias("rank"), "id", "distance")
