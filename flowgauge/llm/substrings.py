"""Substring duplicates by relative Lempel-Ziv parsing against an index of first occurrences."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import NO_ID, spread_join, stored
from flowgauge.llm.phrases import TEXT, Hashes, Lists, Sampling, U, labelled_runs, place, prepared, slices, within, word_symbols

FACTORS = "array<struct<start: long, length: long, source_doc: long, source_start: long>>"
RESULT = f"doc long, n_words long, n_removed long, kept binary, factors {FACTORS}"


def parsed(matches: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """The relative Lempel-Ziv parse of one text: start, length, source document, mark and start of each factor.

    ``matches`` has a row (start, stop, source document, mark, source start) for each stretch that the reference holds.
    Stretches that copy one source at one displacement and overlap or touch are one. The parse goes from left to right:
    where the last factor ended, the next is the match that reaches furthest from there, and where none goes on, the
    text's own words are skipped up to the next match. So factors do not overlap. A factor shorter than a window is
    the rest of a match that began before it, in the factor ahead: a window over that boundary stands in the reference.
    """
    shift = matches[:, 0] - matches[:, 4]
    order = np.lexsort((matches[:, 0], shift, matches[:, 3], matches[:, 2]))
    matches, shift = matches[order], shift[order]
    if not len(matches):
        return []
    same = (shift[1:] == shift[:-1]) & (matches[1:, 2:4] == matches[:-1, 2:4]).all(axis=1)
    group = np.cumsum(np.concatenate(([0], ~same)))
    # Inside a group stretches are ordered by start; one begins a new stretch if all before it have ended.
    base = group * (int(matches[:, 1].max()) + 1)
    reached = np.maximum.accumulate(matches[:, 1] + base)
    heads = np.flatnonzero(np.concatenate(([True], ~same | (matches[1:, 0] + base[1:] > reached[:-1]))))
    stops = np.maximum.reduceat(matches[:, 1], heads)
    merged = sorted(zip(matches[heads, 0].tolist(), stops.tolist(), *(matches[heads, c].tolist() for c in (2, 3, 4)), strict=True))
    out, at, best = [], 0, None
    cursor = 0
    while True:
        while cursor < len(merged) and merged[cursor][0] <= at:
            if best is None or merged[cursor][1] > best[1]:
                best = merged[cursor]
            cursor += 1
        if best is not None and best[1] > at:
            start, stop, doc, mark, source = best
            out.append((at, stop - at, doc, mark, source + at - start))
            at = stop
        elif cursor < len(merged):
            at = merged[cursor][0]
        else:
            return out


def remove_repeats(
    docs: DataFrame, window: int = 20, phrase: int = 6, doc_id: str = "doc_id", text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """doc_id, n_words, n_removed, kept text and the copied factors of every row, and in ``carried`` its ``carry`` columns.

    A word is removed if a window of ``window`` words over it also starts earlier: in a smaller id, or before in the
    same text. Windows are judged on the input. Words are what stands between ASCII white space, unchanged.

    The reference is everything that stands earlier, as an index of each fragment's first place, in blocks by phrase
    hash; a document's fragments are looked up in the block that can hold them. Windows near the edge of a copied
    passage lie in fragments that stand nowhere whole; these are looked up one by one against the first place of each
    such window. From what was found, every document is parsed greedily from left to right into factors (start, length,
    source_doc, source_start), each the longest that goes on from there in any block; see ``parsed``. Factors of a window
    or more, and shorter ones whose boundary with the factor ahead lies inside a window that stands in the reference,
    are the removed words.

    Null and empty texts have no words. A null id counts as the least id. Rows with one id and equal texts are one
    document and get equal results; rows with one id and different texts are ordered by a hash of the text. No rows
    give no rows; other columns are not read, whatever their names. A text is worked on whole, in memory in proportion
    to it. Hashes: words, windows and fragments are told apart by 64 bits each, windows by two such hashes.
    """
    how = Sampling(word_symbols, window, phrase)
    carried = F.struct(F.lit(True).alias("_"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(carry)])
    texts = prepared(docs, doc_id, text, carried if carry else None)
    runs = labelled_runs(texts, how)
    source = [F.col(f"source.{c}").alias(f"s_{c}") for c in (*TEXT, "pos")]
    per_doc = stored(runs.groupBy(*TEXT).agg(F.collect_list(F.struct("pos", "lead", "windows", "known", *source)).alias("runs")))

    def boundary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, mark = batch.column("doc").to_numpy(), batch.column("mark").to_numpy()
            lists = Lists(batch.column("runs"))
            for at, to, data, offsets in slices(batch.column("text")):
                s = word_symbols(data, offsets)
                one, two = Hashes(s.symbols, 0), Hashes(s.symbols ^ (s.symbols >> U(17)), 1)
                row, pos, lead, windows, known, *_ = lists.of(at, to)
                row, first, windows = row[~known], (pos - lead)[~known], windows[~known]
                start = np.repeat(s.first[row] + first, windows) + within(windows)
                row = np.repeat(row, windows)
                columns = (doc[at:to][row], mark[at:to][row], start - s.first[row], one.of(start, start + window).view(np.int64), two.of(start, start + window).view(np.int64))
                yield pa.record_batch([pa.array(c) for c in columns], names=[*TEXT, "pos", "h", "g"])

    looked_up = texts.join(per_doc.filter(F.exists("runs", lambda r: ~r["known"])), TEXT).select(*TEXT, "text", "runs")
    windows = stored(looked_up.mapInArrow(boundary, "doc long, mark long, pos long, h long, g long"))
    firsts = stored(windows.groupBy("h", "g").agg(F.min(place()).alias("first"), F.count("*").alias("n")).filter("n > 1"))
    again = spread_join(windows, firsts, ["h", "g"], "n").filter(place() != F.col("first"))
    found = [F.col(f"first.{c}").alias(f"s_{c}") for c in (*TEXT, "pos")]
    again = again.groupBy(*TEXT).agg(F.collect_set(F.struct("pos", *found)).alias("singles"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column("doc").to_numpy()
            lists, singles = Lists(batch.column("runs")), Lists(batch.column("singles"))
            for at, to, data, offsets in slices(batch.column("text")):
                s = word_symbols(data, offsets)
                fields = lists.of(at, to)
                row, pos, lead, n, _, s_doc, s_mark, s_pos = (c[fields[4]] for c in fields)
                single_row, single, from_doc, from_mark, from_pos = singles.of(at, to)
                rows = np.concatenate([row, single_row])
                matches = np.concatenate(
                    [
                        np.stack([pos - lead, pos - lead + n + window - 1, s_doc, s_mark, s_pos - lead], axis=1),
                        np.stack([single, single + window, from_doc, from_mark, from_pos], axis=1),
                    ]
                )
                order = np.argsort(rows, kind="stable")
                edge = np.searchsorted(rows[order], np.arange(to - at + 1))
                raw = data.tobytes()
                out = {c: [] for c in ("n_words", "n_removed", "kept", "factors")}
                for i in range(to - at):
                    a, b = int(s.first[i]), int(s.first[i + 1])
                    factors = parsed(matches[order[edge[i] : edge[i + 1]]], window)
                    keep = np.ones(b - a, bool)
                    for start, length, *_ in factors:
                        keep[start : start + length] = False
                    chosen = a + np.flatnonzero(keep)
                    out["n_words"].append(b - a)
                    out["n_removed"].append(sum(f[1] for f in factors))
                    out["kept"].append(b" ".join([raw[x:y] for x, y in zip(s.starts[chosen].tolist(), s.stops[chosen].tolist(), strict=True)]))
                    out["factors"].append([dict(start=p, length=n, source_doc=None if d == NO_ID else d, source_start=r) for p, n, d, _, r in factors])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[at:to]), pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.binary())]
                    + [pa.array(out["factors"], pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "source_doc", "source_start")])))]
                    + ([batch.column("carried").slice(at, to - at)] if carry else []),
                    names=["doc", "n_words", "n_removed", "kept", "factors"] + (["carried"] if carry else []),
                )

    all_texts = texts.join(per_doc, TEXT, "left").join(again, TEXT, "left").select(*texts.columns, "runs", "singles")
    schema = RESULT + (f", carried {texts.schema['carried'].dataType.simpleString()}" if carry else "")
    out = all_texts.mapInArrow(cut, schema)
    return out.select(
        F.nullif(F.col("doc"), F.lit(NO_ID).cast("long")).alias("doc_id"), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"), "factors", *out.columns[5:]
    )


def without_repeats(docs: DataFrame, window: int = 20, phrase: int = 6, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with their texts cut down to the words kept; other columns, whatever their names, as they are.

    Null texts stay null, a text without a repeat has its words joined by one space. No row is dropped.
    """
    cut = remove_repeats(docs, window, phrase, doc_id, text, docs.columns)
    before = {c: F.col(f"carried._{i}") for i, c in enumerate(docs.columns)}
    columns = before | {text: F.when(before[text].isNotNull(), F.col("kept"))}
    return cut.select(*[columns[c].alias(c) for c in docs.columns])
