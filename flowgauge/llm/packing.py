"""Sum-of-squares online packing of tokenized documents into fixed windows."""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    + [("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes.

    The vocabulary is that of a byte-level ``tokenizers`` file, whose ids rank its merges; the merges run in the faster
    of the two installed libraries, which gives the same ids (tested). A space between two characters that are not
    white space always starts a new pre-token, so a text is cut there, and pieces met before come from a cache of at
    most ``most`` pieces. Texts with other runs of white space are encoded whole.
    """

    def __init__(self, path: str, most: int = 600_000):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        vocabulary = described["model"]["vocab"]
        # Tokens added to the vocabulary are found in the raw text before anything else, the longest first.
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in described.get("added_tokens", ())}
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        # The file spells each byte as a printable character: itself where it is one, else the next from U+0100 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spelled = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        ranks = {bytes(spelled[c] for c in token): i for token, i in vocabulary.items() if all(c in spelled for c in token)}
        for token in self.added:
            ranks.pop(token.encode(), None)
        self.encode = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.most, self.cache = most, {}

    def whole(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()

    def piece(self, p: str) -> bytes | None:
        """Ids of a piece and the space before it; None if it must not be cut off."""
        if not p or p[0].isspace() or p[-1].isspace():
            return None
        ids = array("I", self.encode(" " + p)).tobytes()
        if len(self.cache) < self.most and len(p) < 64:
            self.cache[p] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if self.split is None or not self.split.search(text):
            return self.plain(text)
        parts = self.split.split(text)
        return b"".join(self.added[p] if i % 2 else self.plain(p) for i, p in enumerate(parts) if p)

    def plain(self, text: str) -> bytes:
        first, *pieces = text.split(" ")
        if not pieces:
            return self.whole(text)
        known = list(map(self.cache.get, pieces))
        if None in known:
            known = [self.piece(p) if ids is None else ids for p, ids in zip(pieces, known, strict=True)]
        if None in known or not first or first[-1].isspace():
            return self.whole(text)
        return self.whole(first) + b"".join(known)


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """One per Python worker, for all of its tasks."""
    return Encoder(path)


class Packer:
    """Windows of ``size`` tokens. ``levels[l]`` counts the open windows filled to level l, in steps of ``unit`` tokens.

    A piece goes where the sum of the squared counts of partially filled windows becomes least: into an open window that
    it fits, or a new one; the fullest of equals. A window in its last step is filled up with the first tokens of the next
    piece, so it has no padding. Few levels keep few windows open: only their pieces are held.
    """

    def __init__(self, size: int, first: int, unit: int = 32):
        self.size, self.unit, self.top, self.next = size, unit, size // unit, first
        self.levels = np.zeros(self.top + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(self.top + 1)]
        self.nearly: list[list] = []
        self.placed = self.moved = 0  # tokens placed by the sum of squares, and those of them that were moved at the end

    def new_id(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, n: int) -> int:
        """The level at which a piece of n steps goes; 0 opens a window."""
        size, levels = self.top, self.levels
        change = np.where(levels[: size - n + 1] > 0, 1 - 2 * levels[: size - n + 1], np.iinfo(np.int64).max // 4)
        change[0] = 0
        change[:-1] += 2 * levels[n:size] + 1
        return int(size - n - np.argmin(change[::-1]))

    @staticmethod
    def filled(window: list) -> int:
        return sum(len(p[2]) for p in window) // 4

    def add(self, piece: tuple) -> Iterator[tuple]:
        """Put (doc_id, start, ids, doc_tokens) into a window; gives the rows of the windows that it fills."""
        doc, start, ids, total = piece
        while self.nearly and ids:
            window = self.nearly[-1]
            n = min(self.size - self.filled(window), len(ids) // 4)
            window.append((doc, start, ids[: 4 * n], total))
            start, ids = start + n, ids[4 * n :]
            if self.filled(window) == self.size:
                yield from self.closed(self.nearly.pop())
        n = len(ids) // 4
        if not n:
            return
        self.placed += n
        level = self.place(-(-n // self.unit))
        if level:
            self.levels[level] -= 1
            window = self.windows[level].pop()
        else:
            window = []
        window.append((doc, start, ids, total))
        held = self.filled(window)
        reached = -(-held // self.unit)
        if held == self.size:
            yield from self.closed(window)
        elif reached == self.top:
            self.nearly.append(window)
        else:
            self.levels[reached] += 1
            self.windows[reached].append(window)

    def closed(self, window: list) -> Iterator[tuple]:
        at, sequence = 0, self.new_id()
        for doc, start, ids, total in window:
            yield doc, start, len(ids) // 4, ids, total, sequence, at
            at += len(ids) // 4

    def rest(self) -> Iterator[tuple]:
        """The windows still open at the end, without padding: the fullest stay as they are and are filled up with tokens of
        the least full; what is left of these in the end is cut into powers of two."""
        open_ = sorted([*self.nearly, *(w for level in self.windows for w in level)], key=self.filled)
        while len(open_) > 1:
            window = open_.pop()
            gap = self.size - self.filled(window)
            while gap and open_:
                doc, start, ids, total = open_[0].pop()
                n = min(gap, len(ids) // 4)
                window.append((doc, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    open_[0].append((doc, start + n, ids[4 * n :], total))
                elif not open_[0]:
                    del open_[0]
                gap -= n
                self.moved += n
            if gap:
                open_ = [window]
            else:
                yield from self.closed(window)
        left = sum(map(self.filled, open_))
        room, window = 0, []
        for doc, start, ids, total in (p for w in open_ for p in w):
            while ids:
                if not room:
                    room = 1 << (left.bit_length() - 1)
                n = min(room, len(ids) // 4)
                window.append((doc, start, ids[: 4 * n], total))
                start, ids, room, left = start + n, ids[4 * n :], room - n, left - n
                if not room:
                    yield from self.closed(window)
                    window = []


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack every document's tokens into sequences of at most ``size`` tokens: one row per piece, with its ids.

    A document is its token ids and then ``end_id``. Whole windows are cut off first; the rest of at most size - 1
    tokens is placed by the sum of squares. Each input partition packs its own documents in one pass, without a shuffle,
    and at its end fills the fullest open windows up from the least full, the last into powers of two, so nothing is
    padded. ``ids`` holds
    little-endian unsigned 32-bit ids; ``size`` is a power of two.

    Null and empty texts are the end id alone. Repeated rows are packed each. A null id stays null. Long texts are cut
    over many windows. No rows give no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        packer = Packer(size, TaskContext.get().partitionId() << 33)

        def rows(batch):
            ids = batch.column(0).to_pylist()
            for doc, content in zip(ids, batch.column(1).to_pylist(), strict=True):
                encoded = encode(content) + end
                total, at = len(encoded) // 4, 0
                while total - at >= size:
                    yield from packer.closed([(doc, at, encoded[4 * at : 4 * (at + size)], total)])
                    at += size
                if at < total:
                    yield from packer.add((doc, at, encoded[4 * at :], total))

        def out(found):
            columns = list(zip(*found, strict=True)) or [()] * len(ARROW)
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                yield out(list(rows(batch.slice(i, 256))))
        yield out(list(packer.rest()))

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return slim.mapInArrow(run, SCHEMA)
