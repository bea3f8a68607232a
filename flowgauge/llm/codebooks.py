"""Vector code compression: product codes whose distances come from tables over each component's distinct integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import spread_join, stored
from flowgauge.llm.embeddings import by_dim

LARGEST = 1 << 28  # integers beyond are set to this, so that sums of squares of a part stay inside 64 bits
BLOCK = 8192  # vectors whose components share one dictionary


@dataclass(frozen=True)
class Codebooks:
    """entries[part][entry] is a tuple of integers."""

    entries: tuple[tuple[tuple[int, ...], ...], ...]

    def sha256(self) -> str:
        """Digest of all integers in decimal, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(str(x) for part in self.entries for entry in part for x in entry).encode()).hexdigest()


def integers(raw: np.ndarray, steps: int) -> np.ndarray:
    """floor(steps * x) of each component, at most LARGEST in size."""
    return np.clip(np.floor(raw.astype(np.float64) * steps), -LARGEST, LARGEST).astype(np.int64)


def part_distances(values: list[np.ndarray], codes: np.ndarray, entries: tuple[tuple[int, ...], ...], at: int) -> np.ndarray:
    """Squared distances of the rows' part that begins at component ``at`` to each entry.

    For each component, the squared differences of its distinct integers to all entries are tabulated once; a row's
    distance is the sum of the rows of these tables that its dictionary codes name.
    """
    table = np.array(entries, np.int64)
    total = np.zeros((len(codes), len(entries)), np.int64)
    for i in range(table.shape[1]):
        squares = (values[at + i][:, None] - table[None, :, i]) ** 2
        total += squares[codes[:, at + i]]
    return total


def blocks_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, list[np.ndarray], np.ndarray]]:
    """Of each stored block its rows, and per component the distinct integers and the rows' codes."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            sizes = np.frombuffer(one.column("sizes")[0].as_py(), np.int32)
            values = np.split(np.frombuffer(one.column("values")[0].as_py(), np.int64), np.cumsum(sizes)[:-1])
            codes = np.frombuffer(one.column("codes")[0].as_py(), np.uint16).reshape(-1, len(sizes))
            yield one, len(codes), values, codes


def encode(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, steps: int = 4096, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors, and the codebooks: vec_id, label, code (array of entry numbers, one a part) and error.

    Components become integers floor(steps * x) and vectors are cut into equal parts. A part's codebook begins as that part
    of the ``entries`` vectors of least id and is moved ``rounds`` times: parts go to the nearest entry, ties to
    the lower one; then each used entry becomes the floor of its parts' mean.

    Blocks of vectors are stored as dictionary codes: per component the block's distinct integers and one code a row. A
    dictionary has no more values than its block has rows, whatever the range of the data. Each round reads the codes,
    tabulates the squared differences of the distinct integers to all entries, and sums what the codes name. Only sums
    and counts per entry leave a task; the driver holds one codebook.

    Vectors that are null or hold null or non-finite components are dropped. The length of vectors is the commonest one
    that ``parts`` divides (the lesser, if several are as common); vectors of other lengths, empty ones too, have null
    code and error and take no part. Integers beyond 2^28 count as 2^28. Null ids come after all others, equal ids are
    ordered by their vectors. Repeated rows are kept. Fewer vectors than ``entries`` give a smaller codebook, no rows no
    rows. Other columns are not read.
    """
    finite = F.coalesce(F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)), F.lit(False))
    kept = vectors.filter(finite).select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vec"))
    lengths = kept.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows")).filter((F.col("n") > 0) & (F.col("n") % parts == 0))
    common = lengths.orderBy(F.desc("rows"), "n").first()
    types = {c: kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    if common is None:
        none = kept.select("vec_id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
        return none, Codebooks(tuple(() for _ in range(parts)))
    dim = common["n"]
    width = dim // parts
    fitting = kept.filter(F.size("vec") == dim)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                for _, _, raw in by_dim(batch.column("vec")):
                    distinct = [np.unique(column, return_inverse=True) for column in integers(raw, steps).T]
                    values, codes = [d[0] for d in distinct], np.stack([d[1] for d in distinct], axis=1).astype(np.uint16)
                    sizes = np.array([len(v) for v in values], np.int32)
                    lists = [pa.ListArray.from_arrays(pa.array([0, len(codes)], pa.int32()), pa.concat_arrays([batch.column(c)])) for c in ("vec_id", "label")]
                    packed = [pa.array([x.tobytes()], pa.binary()) for x in (sizes, np.concatenate(values), codes)]
                    yield pa.RecordBatch.from_arrays([*lists, *packed], names=["ids", "labels", "sizes", "values", "codes"])

    schema = f"ids array<{types['vec_id']}>, labels array<{types['label']}>, sizes binary, values binary, codes binary"
    coded = stored(fitting.mapInArrow(compress, schema))
    seeds = fitting.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    first = integers(np.array([r["vec"] for r in seeds], np.float64), steps).tolist()
    books = Codebooks(tuple(tuple(tuple(row[p * width : (p + 1) * width]) for row in first) for p in range(parts)))

    def nearest(books: Codebooks, values: list[np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chosen, error = np.zeros((len(codes), parts), np.int64), np.zeros(len(codes), np.int64)
        for p in range(parts):
            far = part_distances(values, codes, books.entries[p], p * width)
            chosen[:, p] = far.argmin(axis=1)  # the first of equals
            error += far[np.arange(len(far)), chosen[:, p]]
        return chosen, error

    def summed(books: Codebooks):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = len(books.entries[0])
            counts, sums = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
            for _, _, values, codes in blocks_in(batches):
                chosen, _ = nearest(books, values, codes)
                for p in range(parts):
                    counts[p] += np.bincount(chosen[:, p], minlength=k)
                    for i in range(width):
                        np.add.at(sums[p, :, i], chosen[:, p], values[p * width + i][codes[:, p * width + i]])
            used = np.argwhere(counts > 0)
            part, entry = used[:, 0], used[:, 1]
            flat = sums[part, entry].reshape(-1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(counts[part, entry]), lists], names=["part", "entry", "n", "sums"])

        return run

    for _ in range(rounds):
        per_task = coded.mapInArrow(summed(books), "part long, entry long, n long, sums array<long>")
        totals = per_task.groupBy("part", "entry").agg(
            F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), *[F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        )
        moved = {(r["part"], r["entry"]): tuple(int(r[f"s{i}"]) // int(r["n"]) for i in range(width)) for r in totals.collect()}
        books = Codebooks(tuple(tuple(moved.get((p, e), entry) for e, entry in enumerate(book)) for p, book in enumerate(books.entries)))

    final = books

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, n, values, codes in blocks_in(batches):
            chosen, error = nearest(final, values, codes)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * parts, pa.int32()), pa.array(chosen.reshape(-1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([one.column("ids").flatten(), one.column("labels").flatten(), lists, pa.array(error)], names=["vec_id", "label", "code", "error"])

    out = coded.mapInArrow(assign, f"vec_id {types['vec_id']}, label {types['label']}, code array<int>, error long")
    others = kept.filter(F.size("vec") != dim).select("vec_id", "label", F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error"))
    return out.unionByName(others), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """The codes with ``label_error``: the sum of errors of all rows with an equal label, null labels together.

    A label may hold any share of the rows: sums are combined before the shuffle, and the rows of a frequent label are
    dealt over salts when the sums are joined back.
    """
    rows = stored(codes)
    rows = rows.withColumn("_text", F.coalesce(F.col("label").cast("string"), F.lit(""))).withColumn("_none", F.col("label").isNull())
    sums = stored(rows.groupBy("_none", "_text").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    return spread_join(rows, sums, ["_none", "_text"], "n").select(*codes.columns, "label_error")
