"""Sampled phrases of texts: which stretches of a corpus can occur twice, and where each occurs first.

Texts are sequences of symbols (words or bytes). In every window of ``window`` symbols the phrase of ``phrase`` symbols
with the least hash is sampled, so that equal windows sample equal phrases at equal places. The windows that sample one
phrase are a run, and together cover one *fragment* of the text. Two windows can only be equal if their phrases are.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import NO_ID, spread_join, stored

U = np.uint64
BASES = (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93))  # odd, so that they can be inverted modulo 2^64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
SLICE = 1 << 20  # bytes of text that are worked on at once, or one text if it is longer


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@functools.lru_cache(8)
def _powers(which: int, inverse: bool, n: int) -> np.ndarray:
    base = BASES[which] if not inverse else U(pow(int(BASES[which]), -1, 1 << 64))
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(which: int, inverse: bool, n: int) -> np.ndarray:
    return _powers(which, inverse, max(1 << 16, 1 << (n - 1).bit_length()))[:n]


class Hashes:
    """Hashes of any stretches of a symbol array, from running sums of symbols times powers of a base."""

    def __init__(self, symbols: np.ndarray, which: int = 0):
        self.which, n = which, len(symbols)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(symbols * powers(which, False, n), out=self.sums[1:])
        self.back = powers(which, True, n + 1)

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.back[start])


@dataclass
class Slice:
    """Some texts of a batch. ``first[i]:first[i + 1]`` are the symbols of text i; ``starts`` and ``stops`` their bytes."""

    symbols: np.ndarray
    first: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray


def word_symbols(data: np.ndarray, offsets: np.ndarray) -> Slice:
    """Words between the six ASCII white-space bytes, as 64-bit hashes."""
    n = len(data)
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    stops = np.flatnonzero(inside & (~after | edge[1:])) + 1
    table = mixed(np.arange(1, 257, dtype=U) * BASES[1])
    words = Hashes(table[data], 0).of(starts, stops) ^ mixed((stops - starts).astype(U))
    return Slice(mixed(words), np.searchsorted(starts, offsets), data, starts, stops)


def byte_symbols(data: np.ndarray, offsets: np.ndarray) -> Slice:
    at = np.arange(len(data))
    return Slice(mixed(np.arange(1, 257, dtype=U) * BASES[1])[data], offsets, data, at, at + 1)


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows from:to of a binary column without nulls, with their bytes and offsets, in slices of bounded size."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each place the leftmost position of the least of the next ``width`` values."""
    best, at, have = values.copy(), np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        later, its = best[step:], at[step:]
        best, at = best[: len(later)], at[: len(later)]
        take = later < best
        best, at = np.where(take, later, best), np.where(take, its, at)
        have += step
    return at


@dataclass(frozen=True)
class Sampling:
    symbols: Callable[[np.ndarray, np.ndarray], Slice]
    window: int
    phrase: int

    def runs(self, s: Slice) -> tuple[np.ndarray, ...]:
        """Per run: text's row, place of the phrase in the slice, its hash, the fragment's hash, first window, windows."""
        n = len(s.symbols)
        empty = np.zeros(0, np.int64)
        if n < self.window:
            return empty, empty, empty.view(U), empty.view(U), empty, empty
        a, b = Hashes(s.symbols, 0), Hashes(s.symbols ^ (s.symbols >> U(17)), 1)
        hashed = a.of(slice(0, n - self.phrase + 1), slice(self.phrase, n + 1))
        chosen = sliding_argmin(hashed, self.window - self.phrase + 1)
        row = np.repeat(np.arange(len(s.first) - 1), np.diff(s.first))
        begin = np.flatnonzero(row[: n - self.window + 1] == row[self.window - 1 :])
        if not len(begin):
            return empty, empty, empty.view(U), empty.view(U), empty, empty
        at = chosen[begin]
        heads = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (row[begin[1:]] != row[begin[:-1]]))))
        tails = np.concatenate((heads[1:], [len(begin)])) - 1
        lo, hi, at = begin[heads], begin[tails], at[heads]
        fragment = b.of(lo, hi + self.window) ^ mixed(((at - lo) * 4096 + (hi - lo)).astype(U))
        return row[lo], at, hashed[at], fragment, lo, hi - lo + 1


def prepared(docs: DataFrame, doc_id: str, text: str, carried: Column | None = None) -> DataFrame:
    """``doc`` without nulls, ``mark``, the UTF-8 bytes of ``text``, and a struct of columns to carry along.

    Texts are told apart by (doc, mark). The mark is 0 where ids are unique, else 64 bits of a hash of the text, so that
    rows of one id, null ids included, never share their places.
    """
    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID).cast("long")).alias("doc")
    repeated = not docs.select(doc).groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    mark = F.xxhash64(whole) if repeated else F.lit(0).cast("long")
    extra = [] if carried is None else [carried.alias("carried")]
    return docs.select(doc, mark.alias("mark"), whole.alias("text"), *extra)


RUNS = "doc long, mark long, pos long, a long, f long, lead int, windows int"
RUNS_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc", "mark", "pos", "a", "f")] + [(c, pa.int32()) for c in ("lead", "windows")]
)
TEXT = ["doc", "mark"]  # what names a text


def all_runs(texts: DataFrame, how: Sampling) -> DataFrame:
    """One row per run of every text: phrase place ``pos``, phrase hash, fragment hash, number of symbols of the fragment
    before the phrase, and number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for at, to, data, offsets in slices(batch.column(2)):
                s = how.symbols(data, offsets)
                row, place, a, f, lo, n = how.runs(s)
                columns = (doc[at:to][row], mark[at:to][row], place - s.first[row], a.view(np.int64), f.view(np.int64), (place - lo).astype(np.int32), n.astype(np.int32))
                yield pa.record_batch([pa.array(c) for c in columns], schema=RUNS_ARROW)

    return texts.select(*TEXT, "text").mapInArrow(run, RUNS)


def place() -> Column:
    return F.struct(*TEXT, "pos")


def labelled_runs(texts: DataFrame, how: Sampling) -> DataFrame:
    """The runs whose phrase occurs elsewhere, with what is known of their windows.

    ``known``: the same fragment stands earlier, at phrase place ``source``: all of its windows are repeats. Otherwise
    this is the fragment's first place; other fragments have its phrase, so its windows must be looked up one by one.
    Runs with a phrase or fragment of their own are left out: their windows start nowhere earlier.

    Every step is an aggregate with a map-side combine, or a join that deals the rows of a frequent phrase or fragment
    over salts by its stored count, so one passage may hold any share of the corpus.
    """
    phrases = stored(all_runs(texts, how).groupBy("a").agg(F.count("*").alias("n")).filter("n > 1"))
    hits = stored(spread_join(all_runs(texts, how), phrases, ["a"], "n").drop("n"))
    firsts = hits.groupBy("a", "f").agg(F.min(place()).alias("source"), F.count("*").alias("n"))
    firsts = stored(firsts)
    kinds = stored(firsts.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1"))
    several = stored(spread_join(firsts.select("a", "f"), kinds, ["a"], "n").select("a", "f", F.lit(True).alias("several")))
    index = stored(firsts.join(several, ["a", "f"], "left").filter((F.col("n") > 1) | F.col("several")))
    joined = spread_join(hits, index, ["a", "f"], "n").withColumn("known", place() != F.col("source"))
    return joined.filter(F.col("known") | F.col("several")).select(*TEXT, "pos", "lead", "windows", "known", "source")


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... counts[i] - 1 for each i in turn."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Lists:
    """Numpy columns of an Arrow column of lists of structs."""

    def __init__(self, column: pa.Array):
        self.offsets = np.concatenate(([0], np.cumsum(np.nan_to_num(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64))))
        flat = column.flatten()
        self.columns = [f.to_numpy(zero_copy_only=False) for f in flat.flatten()] if len(flat) else [np.zeros(0, np.int64)] * flat.type.num_fields

    def of(self, at: int, to: int) -> tuple[np.ndarray, ...]:
        """Row within at:to, and the fields, of the entries of these rows."""
        part = slice(self.offsets[at], self.offsets[to])
        row = np.repeat(np.arange(to - at), np.diff(self.offsets[at : to + 1]))
        columns = [c[part] for c in self.columns]
        return row, *(c.astype(bool) if c.dtype == bool or c.dtype == object else c.astype(np.int64) for c in columns)
