"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import stored
from flowgauge.llm.phrases import BASES, Hashes, U, mixed, slices

BITS = 18
BIAS = 1 << BITS  # the last weight
LETTERS = np.zeros(256, bool)  # bytes of a word: ASCII letters and digits, and every byte of other characters
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    LETTERS[_first : _last + 1] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def features(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text of a binary column without nulls, the sorted numbers of the hashed features it holds.

    Features are the words, the pairs of neighbours, and the pairs with one word left out between them; a feature that a
    text holds several times counts once. Whole texts are read.
    """
    table = mixed(np.arange(1, 257, dtype=U) * BASES[0])
    for at, to, data, offsets in slices(column):
        inside = LETTERS[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.concatenate(([False], inside[:-1]))[: len(data)]
        after = np.concatenate((inside[1:], [False]))[: len(data)]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
        words = mixed(Hashes(table[LOWER[data]], 0).of(starts, stops) ^ (stops - starts).astype(U))
        first = np.searchsorted(starts, offsets)
        shift = U(64 - BITS)
        one = (words >> shift).astype(np.int64)
        two = (mixed(words[:-1] * BASES[0] + words[1:]) >> shift).astype(np.int64)
        three = (mixed(words[:-2] * BASES[1] + words[2:] + U(1)) >> shift).astype(np.int64)
        for i in range(to - at):
            a, b = first[i], first[i + 1]
            yield np.unique(np.concatenate([one[a:b], two[a : max(a, b - 1)], three[a : max(a, b - 2)]]))


@dataclass(frozen=True)
class Rates:
    """The step sizes alpha / (beta + sqrt(squared gradients)) of each coordinate, and both penalties."""

    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 24.0
    l2: float = 0.0

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The closed-form minimum: zero where the summed gradients are within l1."""
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, z: np.ndarray, n: np.ndarray, found: np.ndarray, label: int, weight: float = 1.0) -> None:
        """One example of some weight, in place; the bias is a feature of every text."""
        at = np.append(found, BIAS)
        zs, ns = z[at], n[at]
        w = self.weights(zs, ns)
        w[-1] = -zs[-1] / ((self.beta + np.sqrt(ns[-1])) / self.alpha)  # no penalty on the bias
        g = (sigmoid(w.sum()) - label) * weight
        more = ns + g * g
        z[at] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / self.alpha * w
        n[at] = more


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass(frozen=True)
class Model:
    """The features with a weight, their weights, and the bias: at most 2^BITS of them, 12 bytes each."""

    at: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        place = np.searchsorted(self.at, found)
        place[place == len(self.at)] = 0
        held = self.at[place] == found if len(self.at) else np.zeros(0, bool)
        return float(sigmoid(self.bias + self.weight[place[held]].sum(dtype=np.float64)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    most_rows: int = 20_000,
    most_shards: int = 8,
    epochs: int = 8,
    rates: Rates | None = None,
) -> Model | None:
    """Fit on a bounded sample of labelled documents: the ``most_rows`` of least hash of id and label. None without any.

    Rows of ``labels`` count whose id and label are not null; a positive label is 1. Contradicting labels of one id both
    count. Only text and label are learned from. The sample's features are computed once, in tasks, and dealt by hash to
    one shard for every 1000 examples, ``most_shards`` at most; the sample and its order do not depend on how the tables
    are partitioned. Toxic examples weigh as much in all as the others, up to 20 times as much each.

    In each epoch every shard learns its examples one after another, from the state the last epoch ended with, and the
    changes of all shards are averaged. Averaged gradients are smaller sums, so the L1 penalty is divided by the square
    root of the shards. A task holds one batch of examples and the state of 2^BITS coordinates; the
    driver holds one state and the changes of all shards, 20 bytes a coordinate each. Learning every example in one sequence would need one task for the whole sample.
    """
    ids = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).select(F.col(doc_id).alias("doc"), (F.col(label) == 1).cast("int").alias("y")).distinct()
    few = ids.withColumn("h", F.xxhash64("doc", "y")).orderBy("h", "doc", "y").limit(most_rows)
    # At most most_rows rows, so the broadcast is bounded.
    sample = docs.join(F.broadcast(few), F.col(doc_id) == F.col("doc")).select(
        F.xxhash64("doc", "y", F.coalesce(F.col(text), F.lit(""))).alias("h"), "y", F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t")
    )
    # Ids may repeat among the documents: again no more than most_rows of them, equal rows once.
    last = sample.select("h").distinct().orderBy("h").limit(most_rows).agg(F.max("h")).first()[0]
    if last is None:
        return None

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                found = list(features(batch.column("t")))
                ends = np.concatenate(([0], np.cumsum([len(f) for f in found])))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("y"), lists], names=["h", "y", "found"])

    coded = sample.filter(F.col("h") <= last).dropDuplicates(["h", "y"]).mapInArrow(extract, "h long, y int, found array<int>")
    coded = stored(coded)
    rows, toxic = coded.agg(F.count("*"), F.sum("y")).first()
    shards = max(1, min(most_shards, rows // 1000))
    rates = rates or Rates()
    rates = replace(rates, l1=rates.l1 / np.sqrt(shards))
    heavier = min(20.0, (rows - toxic) / max(1, toxic))
    shard = F.pmod(F.xxhash64("h"), F.lit(shards)).cast("int")
    # One file a shard, in the order of learning: epochs read them as they lie and shuffle nothing.
    coded = stored(coded.withColumn("shard", shard).repartition(shards, "shard").sortWithinPartitions("shard", "h").select("shard", "y", "found"))

    z, n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)

    def epoch(z: np.ndarray, n: np.ndarray):
        def changes(shard: int, mine: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            dz, dn = mine[0] - z, mine[1] - n
            at = np.flatnonzero(dn)
            columns = [pa.array([shard], pa.int32())] + [pa.array([x.tobytes()], pa.binary()) for x in (at.astype(np.int32), dz[at], dn[at])]
            return pa.record_batch(columns, names=["shard", "at", "dz", "dn"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, mine = None, None
            for batch in batches:
                shard, y = batch.column("shard").to_numpy(), batch.column("y").to_numpy()
                found = batch.column("found")
                ends, flat = found.offsets.to_numpy(), found.values.to_numpy()
                for i in range(batch.num_rows):
                    if shard[i] != current:
                        if mine is not None:
                            yield changes(current, mine)
                        current, mine = shard[i], (z.copy(), n.copy())
                    rates.learn(*mine, flat[ends[i] : ends[i + 1]], int(y[i]), heavier if y[i] else 1.0)
            if mine is not None:
                yield changes(current, mine)

        return run

    for _ in range(epochs):
        # A row a shard, each at most 20 bytes a coordinate.
        moved = coded.mapInArrow(epoch(z, n), "shard int, at binary, dz binary, dn binary").collect()
        for row in sorted(moved, key=lambda r: (r["shard"], bytes(r["at"]))):
            at = np.frombuffer(row["at"], np.int32)
            z[at] += np.frombuffer(row["dz"]) / len(moved)
            n[at] += np.frombuffer(row["dn"]) / len(moved)
    w = rates.weights(z, n).astype(np.float32)
    kept = np.flatnonzero(w[:BIAS])
    bias = -z[BIAS] / ((rates.beta + np.sqrt(n[BIAS])) / rates.alpha)
    return Model(kept, w[kept], float(bias))


def score(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score") -> DataFrame:
    """The rows with their score between 0 and 1; higher speaks for toxic.

    Whole texts are read. Null and empty texts, and texts without a word, get the score of a text without features; without
    a model every score is 0. No row is dropped and none moves: there is no shuffle. A column of the result's name is
    replaced, other columns, whatever their names, stay.
    """

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([0.0] * len(column) if model is None else [model.score(f) for f in features(column)], pa.float64())

    return docs.withColumn(name, F.arrow_udf(run, "double")(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a document belongs to the fold that training leaves out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold
