"""SimHash near-duplicates: pigeonhole blocks, verified bit distance, connected groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import checkpointed, spread_join, stored
from flowgauge.llm.components import components

SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash of a text's word shingles, repeats included: a bit is set if it is in over half of the hashes."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, shingle: int) -> Column:
    """A LONG column with the fingerprint's bits, computed from whole texts; null texts have fingerprint 0."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = np.fromiter((0 if t is None else fingerprint(t, shingle) for t in column.to_pylist()), np.uint64, len(column))
            yield pa.array(found.view(np.int64), pa.int64())

    return F.arrow_udf(run, "long")(text.cast("binary"))


def block_masks(blocks: int, agree: int) -> list[int]:
    """Masks of every choice of ``agree`` of ``blocks`` near-equal blocks of the 64 bits, as signed longs."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(parts[i] for i in chosen) for chosen in combinations(range(blocks), agree)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def close_in_group(values: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Links that join all values at most ``distance`` bits apart, as a spanning forest."""
    root = np.arange(len(values))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(1, len(values)):
        near = np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= distance)
        for r in {find(int(j)) for j in near}:
            mine = find(i)
            if r != mine:
                root[max(r, mine)] = min(r, mine)
                yield int(min(r, mine)), int(max(r, mine))


def near_groups(prints: DataFrame, distance: int, blocks: int = 6, chunk: int = 2048) -> DataFrame:
    """``fp``, ``component``: groups of distinct LONG fingerprints (column ``fp``) linked at ``distance`` bits or fewer.

    ``component`` is the group's least fingerprint; fingerprints without a link are absent. Of ``blocks`` blocks, two
    linked fingerprints differ in at most ``distance``, so they agree in some choice of blocks - distance of them. Rows
    are joined on (choice, value of the chosen bits); inside such a bucket, bit distances are verified and only links
    of a spanning forest are given out, so a bucket gives fewer links than it has rows. Buckets of over ``chunk`` rows are cut into
    chunks whose pairs go to different tasks: none is held whole, and no pair of rows is left out.
    """
    if blocks <= distance:
        raise ValueError("there must be more blocks than bits that may differ")
    masks = block_masks(blocks, blocks - distance)
    keyed = prints.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long").bitwiseAND(F.col("fp")) for m in masks])).alias("choice", "part"))
    sizes = keyed.groupBy("choice", "part").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = sizes.select("choice", "part", F.ceil(F.col("n") / chunk).cast("long").alias("chunks"))
    rows = keyed.join(sizes, ["choice", "part"]).withColumn("mine", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")))
    # Chunk i meets chunk j in the task of (i, j), i <= j.
    paired = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
        "choice", "part", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for values in sorted_groups(batches, ["choice", "part", "i", "j"], "fp"):
            if len(values) > 1:
                pairs = np.array(list(close_in_group(values.view(np.uint64), distance)), np.int64).reshape(-1, 2)
                yield pa.record_batch([pa.array(values[pairs[:, 0]]), pa.array(values[pairs[:, 1]])], names=["a", "b"])

    keys = ["choice", "part", "i", "j"]
    links = paired.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(run, "a long, b long")
    return components(links).select(F.col("node").alias("fp"), "component")


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str], value: str) -> Iterator[np.ndarray]:
    """The values of each run of equal keys, from batches sorted by the keys; at most one run and one batch are held."""
    held: list[np.ndarray] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        values = batch.column(value).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        first = tuple(c[0] for c in columns)
        if last is not None and first != last:
            yield np.concatenate(held)
            held = []
        parts = np.split(values, cuts)
        if len(parts) > 1:
            yield np.concatenate([*held, parts[0]])
            yield from parts[1:-1]
            held = []
        held.append(parts[-1])
        last = tuple(c[-1] for c in columns)
    if held:
        yield np.concatenate(held)


def with_prints(docs: DataFrame, shingle: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, fp and two hashes (k1, k2) of id and text, which name a document, checkpointed."""
    key = [F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text)]
    return checkpointed(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            fingerprints(F.col(text), shingle).alias("fp"),
            F.xxhash64(*key).alias("k1"),
            F.xxhash64(F.lit(1), *key).alias("k2"),
        )
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (LONG bits) and component_id of every row: the least doc_id of its group.

    A fingerprint is taken from a whole text; equal fingerprints are one before blocks are joined, so exact copies,
    however many, cost one row. Texts without words, empty and null ones have fingerprint 0 and are linked like any
    other. Repeated rows and ids are kept; a group of nothing but null ids has a null component. No rows give no rows.
    Other columns are not read.
    """
    printed = with_prints(docs, shingle, doc_id, text)
    firsts = stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    groups = checkpointed(near_groups(firsts.select("fp"), distance))
    linked = stored(firsts.join(groups, "fp"))
    least = stored(linked.groupBy("component").agg(F.min("first").alias("least"), F.count("*").alias("size")))
    ids = spread_join(linked.select("fp", "component"), least, ["component"], "size").select("fp", "least")
    per_print = stored(firsts.join(ids, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"), "n"))
    return spread_join(printed, per_print, ["fp"], "n").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group with all its columns, whatever their names: the one with the least id.

    A document is its id and text. Null ids come after all others, so a document without an id stays if its group has no
    other; several documents with one id are told apart by their texts, and of those in one group the one with the least
    hash stays. Of rows equal in id and text, one stays. No rows give no rows.
    """
    printed = with_prints(docs, shingle, doc_id, text)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    firsts = stored(printed.groupBy("fp").agg(F.min(place).alias("first")))
    groups = checkpointed(near_groups(firsts.select("fp"), distance))
    # A fingerprint without links is its own group.
    alone = firsts.join(groups, "fp", "left_anti").select("first")
    kept = firsts.join(groups, "fp").groupBy("component").agg(F.min("first").alias("first")).select("first").unionByName(alone)
    kept = kept.select("first.k1", "first.k2")
    key = [F.col(doc_id).isNull(), F.col(doc_id), F.col(text).isNull(), F.col(text)]
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.xxhash64(*key).alias("k1"), F.xxhash64(F.lit(1), *key).alias("k2"))
    return rows.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")
