"""Ranked lexical search: short posting lists summed first, then a document-at-a-time pass that skips over long ones."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import stored
from flowgauge.operators.ordering import top_rows

SEGMENT = 8192  # documents of one inverted file
RANGE = 256  # documents that one bound of a list covers
NO_DOC = (1 << 63) - 1  # stands for a null id: after all others
# A-Z to a-z; everything but ASCII letters, digits and bytes of other characters separates terms.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Segment:
    """The inverted file of some documents: for each term the documents that hold it, ascending, and how often.

    ``share`` is a posting's part of the score without the term's weight; the lists of a segment share a table of its
    maxima by list and by RANGE of documents.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, term: np.ndarray, df: np.ndarray, docs: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int):
        self.ids, self.n = ids, len(ids)
        if 90 * int(lengths.max(initial=0)) * n_docs < 1 << 62:
            m = 10 + 90 * lengths * n_docs // n_terms
        else:  # beyond 64 bits on the way, not in the result
            m = np.array([10 + 90 * int(x) * n_docs // n_terms for x in lengths], np.int64)
        share = 10**9 * tf // (1000 * tf + 8 * m[docs])
        ends = np.cumsum(df)
        self.lists = {t: (docs[e - d : e], share[e - d : e]) for t, d, e in zip(term.tolist(), df.tolist(), ends.tolist(), strict=True)}
        self.ranges = -(-self.n // RANGE)
        self.row = {t: i for i, t in enumerate(term.tolist())}
        self.most = np.zeros((len(term), self.ranges), np.int64)
        np.maximum.at(self.most, (np.repeat(np.arange(len(term)), df), docs // RANGE), share)

    def search(self, query: list[tuple[int, int]], k: int, best: tuple[np.ndarray, np.ndarray], short: float) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best documents of ``best`` and this segment; equal scores by ascending id.

        Term at a time: the lists of at most ``short`` of the documents are summed into accumulators. These are then one
        more iterator, with a bound for each range, beside the long lists. Document at a time, range by range: a range
        whose bounds add up to less than the kth score is skipped in all lists. Elsewhere the lists that together cannot
        reach that score only complete the documents that the others bring up, the strongest first, and documents that
        can no longer reach it are let go.
        """
        held = [(w, t) for t, w in query if t in self.row and w > 0]
        if not held:
            return best
        sums, bounds, long = np.zeros(self.n, np.int64), [], []
        for w, t in held:
            docs, share = self.lists[t]
            if len(docs) <= short * self.n:
                sums[docs] += w * share
            else:
                long.append((w, *self.lists[t]))
                bounds.append(w * self.most[self.row[t]])
        padded = np.zeros(self.ranges * RANGE, np.int64)
        padded[: self.n] = sums
        bounds = np.array([padded.reshape(-1, RANGE).max(axis=1), *bounds])
        reachable = bounds.sum(axis=0)
        for r in range(self.ranges):
            floor = int(best[0][-1]) if len(best[0]) == k else 1
            if reachable[r] < floor:
                continue
            lo, hi = r * RANGE, min(self.n, (r + 1) * RANGE)
            # Weak lists: by their bounds in this range, as many as stay below the floor together.
            order = np.argsort(bounds[:, r], kind="stable")
            weak = int((np.cumsum(bounds[order, r]) < floor).sum())
            partial = np.zeros(hi - lo, np.int64)
            for i in order[weak:].tolist():
                if i == 0:
                    partial += sums[lo:hi]
                else:
                    w, docs, share = long[i - 1]
                    a, b = np.searchsorted(docs, (lo, hi))
                    partial[docs[a:b] - lo] += w * share[a:b]
            at = np.flatnonzero(partial)
            score = partial[at]
            left = int(bounds[order[:weak], r].sum())
            for i in order[:weak][::-1].tolist():
                alive = score + left >= floor
                at, score = at[alive], score[alive]
                if not len(at):
                    break
                left -= int(bounds[i, r])
                if i == 0:
                    score = score + sums[lo + at]
                else:
                    w, docs, share = long[i - 1]
                    place = np.searchsorted(docs, lo + at)
                    place[place == len(docs)] = 0
                    score = score + np.where(docs[place] == lo + at, w * share[place], 0)
            alive = score >= floor
            if alive.any():
                scores, ids = np.concatenate([best[0], score[alive]]), np.concatenate([best[1], self.ids[lo + at[alive]]])
                top = np.lexsort((ids, -scores))[:k]
                best = scores[top], ids[top]
        return best


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    short: float = 1 / 16,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``k`` best documents with a score above 0.

    Terms are maximal runs of ASCII letters, digits and other characters, only A-Z lower-cased; a document's score sums over the
    item's terms, once each, the term's weight times a share that grows with the term's count in the document and falls
    with the document's length. All of it is in whole numbers but the logarithm of the weight.

    Documents are read in whole and become inverted files of up to SEGMENT documents, over the terms that items ask for;
    these are stored, and document counts and lengths are summed from them. Each task then searches its files one after the
    other, see ``Segment.search``, and gives k rows an item; the best of all tasks are ranked. Items are held in each
    task, so they are taken in blocks of about ``block_bytes`` of text; each block reads the documents once.

    Null and empty texts have no terms: such documents are in no count, such items have no rows. Rows repeated among
    the documents rank beside each other; a null doc_id comes after all others of its score. Rows of items that are equal
    in id and text are one item; rows with one id and different texts are ranked each on its own. Ids are LONG. Other
    columns are not read. Empty tables give no rows.
    """
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).cast("binary").alias("text")).distinct()
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    files = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_DOC)).alias("doc"), F.coalesce(F.col(doc_text), F.lit("")).cast("binary").alias("text"))
    found = []
    for block in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).collect()
        ordered = sorted(((r["item_id"], bytes(r["text"])) for r in mine), key=repr)
        found.append(rank_block(files, ordered, k, short).withColumn("block", F.lit(block)))
    best = reduce(DataFrame.unionByName, found)
    ranked = top_rows(best, ["block", "q", "item_id"], [F.desc("score"), F.asc("doc")], k, "rank")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), F.nullif("doc", F.lit(NO_DOC)).alias("doc_id"), "score")


def rank_block(files: DataFrame, items: list[tuple[int | None, bytes]], k: int, short: float) -> DataFrame:
    """q, item_id, doc and score: the k best documents that each task finds for each item of a block."""
    wanted = [sorted(set(terms(text))) for _, text in items]
    number = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
    schema = "docs long, terms long, ids array<long>, lengths binary, term array<int>, df array<int>, holders binary, tf binary"

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SEGMENT):
                batch = whole.slice(start, SEGMENT)
                n_docs = n_terms = 0
                ids, lengths, holder, term, tf = [], [], [], [], []
                for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
                    counts = Counter(terms(text.as_py()))
                    length = counts.total()
                    n_docs, n_terms = n_docs + (length > 0), n_terms + length
                    hits = counts.keys() & number.keys()
                    if hits:
                        holder += [len(ids)] * len(hits)
                        term += [number[t] for t in hits]
                        tf += [counts[t] for t in hits]
                        ids.append(doc)
                        lengths.append(length)
                term = np.array(term, np.int32)
                order = np.argsort(term, kind="stable")
                distinct, df = np.unique(term, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n_docs]), pa.array([n_terms]), pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(lengths, np.int64).tobytes()], pa.binary())]
                    + [pa.array([x], pa.list_(pa.int32())) for x in (distinct, df.astype(np.int32))]
                    + [pa.array([np.array(x, np.int32)[order].tobytes()], pa.binary()) for x in (holder, tf)],
                    names=["docs", "terms", "ids", "lengths", "term", "df", "holders", "tf"],
                )

    segments = stored(files.mapInArrow(invert, schema))
    n_docs, n_terms = segments.agg(F.sum("docs"), F.sum("terms")).first()
    pairs = segments.select(F.explode(F.arrays_zip("term", "df")).alias("p"))
    counts = pairs.groupBy(F.col("p.term").alias("term")).agg(F.sum("p.df").alias("df")).collect()  # a row a term asked for
    weight = {r["term"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1))) for r in counts}
    queries = [[(number[t], weight[number[t]]) for t in ts if number[t] in weight] for ts in wanted]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)
        for batch in batches:
            for i in range(batch.num_rows):
                ids, term, df = (batch.column(c)[i].values.to_numpy() for c in ("ids", "term", "df"))
                lengths = np.frombuffer(batch.column("lengths")[i].as_py(), np.int64)
                holders, tf = (np.frombuffer(batch.column(c)[i].as_py(), np.int32).astype(np.int64) for c in ("holders", "tf"))
                if len(ids):
                    segment = Segment(ids, lengths, term, df, holders, tf, n_docs, n_terms)
                    best = [segment.search(q, k, b, short) for q, b in zip(queries, best, strict=True)]
        sizes = [len(b[0]) for b in best]
        q = np.repeat(np.arange(len(best)), sizes)
        scores, docs = (np.concatenate([np.zeros(0, np.int64), *(b[i] for b in best)]) for i in (0, 1))
        item = pa.array([items[i][0] for i in q.tolist()], pa.int64())
        yield pa.record_batch([pa.array(q), item, pa.array(docs), pa.array(scores)], names=["q", "item_id", "doc", "score"])

    return segments.select("ids", "lengths", "term", "df", "holders", "tf").mapInArrow(search, "q long, item_id long, doc long, score long")
