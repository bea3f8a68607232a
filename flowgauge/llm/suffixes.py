"""Repeated byte strings by a sampled suffix array: range-partitioned, sorted in buckets, compared across boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import NO_ID, spread_join, stored
from flowgauge.llm.phrases import TEXT, Lists, Sampling, byte_symbols, labelled_runs, place, prepared, slices

FRAGMENT = "doc long, mark long, pos long, lead int, windows int, suffix binary, before binary"
FOUND = "string binary, doc long, mark long, pos long, windows int"
RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept binary, spans array<struct<start: long, length: long>>"


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Byte strings of at most ``width`` bytes as the rows of a matrix, with zeros behind."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    out = np.zeros((len(column), width), np.uint8)
    rows = np.repeat(np.arange(len(column)), lengths)
    out[rows, np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], lengths)] = data[offsets[0] : offsets[-1]]
    return out


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Lexicographic order of the rows of a byte matrix: sort by the next eight bytes, go on with the ties only."""
    n, width = rows.shape
    wide = np.zeros((n, -(-width // 8) * 8), np.uint8)
    wide[:, :width] = rows
    keys = wide.view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, np.int64)
    open_rows = np.arange(n)  # places in order whose group still has several rows
    for k in range(keys.shape[1]):
        if not len(open_rows):
            break
        mine, key = order[open_rows], keys[order[open_rows], k]
        sorted_ = np.lexsort((key, group[open_rows]))
        order[open_rows] = mine[sorted_]
        key, tied = key[sorted_], group[open_rows]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (tied[1:] != tied[:-1])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(key)))
        group[open_rows] = np.repeat(open_rows[heads], sizes)
        open_rows = open_rows[np.repeat(sizes > 1, sizes)]
    return order


class Ordered:
    """Byte rows in lexicographic order, with the length of the prefix that neighbours share."""

    def __init__(self, rows: np.ndarray):
        self.order = multikey_order(rows)
        differ = rows[self.order[1:]] != rows[self.order[:-1]]
        self.shared = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])

    def classes(self, depth: int) -> np.ndarray:
        """Numbers that are equal for rows with equal first ``depth`` bytes."""
        out = np.zeros(len(self.order), np.int64)
        out[self.order[1:]] = np.cumsum(self.shared < depth)
        return out


def bucket_repeats(table: pa.Table, length: int, phrase: int) -> Iterator[pa.RecordBatch]:
    """The repeats among one bucket's suffixes, and what must be compared with other buckets.

    A string that starts o bytes before a sampled suffix is o bytes before it and length - o of it; the sorted suffixes
    and the sorted texts before them number both. All strings but the first of each kind are repeats. Only strings whose
    part in the suffix is also that of the bucket's first or last suffix can stand in another bucket: the first of each
    is handed on, with its bytes.
    """
    n = table.num_rows
    doc, mark, pos = table["doc"].to_numpy(), table["mark"].to_numpy(), table["pos"].to_numpy()
    lead, windows = table["lead"].to_numpy(), table["windows"].to_numpy()
    suffix, before = padded(table["suffix"].combine_chunks(), length), padded(table["before"].combine_chunks(), length - phrase)
    right, left = Ordered(suffix), Ordered(before)
    earlier = np.lexsort((pos, mark, doc))
    lead, windows = lead[earlier], windows[earlier]
    repeated = np.zeros((n, length - phrase + 2), np.int8)
    for o in range(int(lead.max()) + 1):
        mine = np.flatnonzero((lead >= o) & (lead - windows < o))
        if not len(mine):
            continue
        rows, kinds = earlier[mine], right.classes(length - o)
        key = kinds[rows] * n + left.classes(o)[rows]
        order = np.argsort(key, kind="stable")
        first = np.ones(len(order), bool)
        first[1:] = key[order[1:]] != key[order[:-1]]
        repeated[rows[order[~first]], lead[mine[order[~first]]] - o + 1] = 1
        handed = rows[order[first]]
        handed = handed[np.isin(kinds[handed], kinds[right.order[[0, -1]]])]
        if len(handed):
            strings = np.concatenate([before[handed, :o][:, ::-1], suffix[handed, : length - o]], axis=1)
            yield pa.record_batch(
                [pa.array([s.tobytes() for s in strings], pa.binary()), pa.array(doc[handed]), pa.array(mark[handed]), pa.array(pos[handed] - o), pa.array(np.ones(len(handed), np.int32))],
                names=["string", "doc", "mark", "pos", "windows"],
            )
    # Neighbouring repeats of one fragment are given as one row.
    steps = np.diff(np.pad(repeated, ((0, 0), (0, 1))), axis=1)
    row, start = np.nonzero(steps == 1)
    stop = np.nonzero(steps == -1)[1]
    place_ = pos[row] - table["lead"].to_numpy()[row] + start
    yield pa.record_batch(
        [pa.nulls(len(row), pa.binary()), pa.array(doc[row]), pa.array(mark[row]), pa.array(place_), pa.array((stop - start).astype(np.int32))],
        names=["string", "doc", "mark", "pos", "windows"],
    )


def remove_repeats(
    docs: DataFrame, length: int = 100, phrase: int = 32, doc_id: str = "doc_id", text: str = "text", suffixes_each: int = 50_000
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, the kept bytes and the removed spans of every row.

    A byte is removed if a string of ``length`` bytes over it also starts earlier: in a smaller id, or before in the same
    text. Strings are judged on the input and never cross texts; spans are maximal runs of removed bytes.

    One suffix in about half of length - phrase is sampled, at the phrase of least hash of each string, so equal strings
    are sampled alike. Suffixes whose whole surroundings stand earlier are known repeats at once, and suffixes whose
    phrase stands nowhere else are none. The rest are dealt to buckets by splitters that Spark samples from their
    leading bytes, sorted in each bucket by multikey quicksort and compared with their neighbours; strings that
    a bucket's edge may cut are then compared across buckets. Ties in the bytes are split by id and place, so a
    bucket's size does not depend on how often a passage repeats; there is a bucket for about every ``suffixes_each``
    suffixes. "Known" is judged by 128 bits of hash (64 of the phrase, 64 of its surroundings), not byte by byte; all
    other repeats are found by comparing bytes.

    Null and empty texts have no bytes. A null id counts as the least id. Rows with one id and equal texts are one document
    and get equal results; rows with one id and different texts are ordered by a hash of the text. No rows give no
    rows; other columns are not read. A text is worked on whole, in memory in proportion to it.
    """
    how = Sampling(byte_symbols, length, phrase)
    texts = prepared(docs, doc_id, text)
    runs = labelled_runs(texts, how)
    per_doc = stored(runs.groupBy(*TEXT).agg(F.collect_list(F.struct("pos", "lead", "windows", "known")).alias("runs")))

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
            lists = Lists(batch.column("runs"))
            for at, to, data, offsets in slices(batch.column("text")):
                row, pos, lead, windows, known = lists.of(at, to)
                row, pos, lead, windows = (c[~known] for c in (row, pos, lead, windows))
                middle = offsets[row] + pos
                first, stop = middle - lead, middle - lead + windows + length - 1
                raw = data.tobytes()
                triples = list(zip(first.tolist(), middle.tolist(), stop.tolist(), strict=True))
                yield pa.record_batch(
                    [pa.array(doc[at:to][row]), pa.array(mark[at:to][row]), pa.array(pos), pa.array(lead.astype(np.int32)), pa.array(windows.astype(np.int32))]
                    + [pa.array([raw[m:b] for _, m, b in triples], pa.binary()), pa.array([raw[a:m][::-1] for a, m, _ in triples], pa.binary())],
                    names=["doc", "mark", "pos", "lead", "windows", "suffix", "before"],
                )

    def bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from bucket_repeats(pa.Table.from_batches(held), length, phrase)

    unknown = F.size(F.filter("runs", lambda r: ~r["known"]))
    looked_up = texts.join(per_doc.filter(unknown > 0), TEXT).select(*TEXT, "text", "runs")
    suffixes = per_doc.agg(F.sum(unknown)).first()[0] or 0
    buckets = max(texts.sparkSession.sparkContext.defaultParallelism, -(-suffixes // suffixes_each))
    dealt = looked_up.mapInArrow(fragments, FRAGMENT).repartitionByRange(buckets, "suffix", "before", *TEXT, "pos")
    found = dealt.mapInArrow(bucket, FOUND)
    found = stored(found)
    across = found.filter("string IS NOT NULL")
    firsts = stored(across.groupBy("string").agg(F.min(place()).alias("first"), F.count("*").alias("n")).filter("n > 1"))
    again = spread_join(across, firsts, ["string"], "n").filter(place() != F.col("first"))
    spans = found.filter("string IS NULL").unionByName(again.select(*found.columns))
    per_doc_spans = spans.groupBy(*TEXT).agg(F.collect_list(F.struct("pos", "windows")).alias("starts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc").to_numpy()
            lists, singles = Lists(batch.column("runs")), Lists(batch.column("starts"))
            for at, to, data, offsets in slices(batch.column("text")):
                row, pos, lead, windows, known = (c for c in lists.of(at, to))
                row, first, windows = row[known], (pos - lead)[known], windows[known]
                more_row, more_first, more = singles.of(at, to)
                cover = np.zeros(len(data) + 1, np.int64)
                for r, p, n in ((row, first, windows), (more_row, more_first, more)):
                    np.add.at(cover, offsets[r] + p, 1)
                    np.add.at(cover, offsets[r] + p + n + length - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                edge = np.zeros(len(data) + 1, bool)
                edge[offsets] = True
                begins = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate(([False], gone[:-1]))))
                ends = np.flatnonzero(gone & (edge[1:] | ~np.concatenate((gone[1:], [False])))) + 1
                span_at = np.searchsorted(begins, offsets)
                left = np.concatenate(([0], np.cumsum(~gone)))[offsets]
                kept = data[~gone].tobytes()
                text_of = np.searchsorted(offsets, begins, "right") - 1
                spans_column = pa.ListArray.from_arrays(
                    pa.array(span_at.astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(begins - offsets[text_of]), pa.array(ends - begins)], ["start", "length"]),
                )
                sizes = np.diff(offsets)
                yield pa.record_batch(
                    [pa.array(doc[at:to]), pa.array(sizes), pa.array(sizes - np.diff(left)), pa.array(np.diff(span_at))]
                    + [pa.array([kept[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)], pa.binary()), spans_column],
                    names=["doc", "n_bytes", "n_removed", "n_spans", "kept", "spans"],
                )

    all_texts = texts.join(per_doc, TEXT, "left").join(per_doc_spans, TEXT, "left").select(*TEXT, "text", "runs", "starts")
    out = all_texts.mapInArrow(cut, RESULT)
    return out.select(F.nullif(F.col("doc"), F.lit(NO_ID).cast("long")).alias("doc_id"), *out.columns[1:])
