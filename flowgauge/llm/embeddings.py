"""Near-duplicate vectors by a subspace pigeonhole join with exact verification."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import checkpointed, spread_join, stored
from flowgauge.llm.components import components

SPREAD = 37.5  # byte steps for one standard deviation of a component of a random unit vector
SAMPLE = 20_000  # vectors that trees are fitted on
CELL = 128  # rows of a cell inside a task


@functools.lru_cache(8)
def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


@functools.lru_cache(8)
def blocks_of(dim: int, width: int) -> tuple[tuple[int, int], ...]:
    n = max(1, round(dim / width))
    edges = [dim * i // n for i in range(n + 1)]
    return tuple(zip(edges[:-1], edges[1:], strict=True))


def rotated(raw: np.ndarray) -> np.ndarray:
    """Rotated unit vectors in double precision."""
    whole = raw.astype(np.float64)
    whole /= np.abs(whole).max(axis=1)[:, None]  # so that squares neither overflow nor vanish
    whole /= np.sqrt((whole**2).sum(axis=1))[:, None]
    return whole @ rotation(raw.shape[1])


def scale(dim: int) -> float:
    return SPREAD * float(np.sqrt(dim))


def in_bytes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per component, and each vector's distance from what its bytes say."""
    s = scale(unit.shape[1])
    coded = np.clip(np.rint(unit * s), -127, 127)
    return coded.astype(np.int8), np.sqrt(((unit - coded / s) ** 2).sum(axis=1)) + 1e-6


@functools.lru_cache(8)
def reach(dim: int, width: int, least_cos: float) -> tuple[float, ...]:
    """Per block the squared distance of byte vectors within which every linked pair meets in at least one block.

    Linked unit vectors are at most 2 - 2 * least_cos apart, squared, so in some block at most that block's share. Bytes
    are off by up to half a step per component; cutting off large components brings vectors no further apart.
    """
    most = (2 - 2 * least_cos) * (1 + 1e-6) + 1e-9
    return tuple((scale(dim) * np.sqrt(most * (hi - lo) / dim) + np.sqrt(hi - lo)) ** 2 for lo, hi in blocks_of(dim, width))


@dataclass(frozen=True)
class Node:
    """A cut of one component, or a leaf with its number and the number of chunks its rows are dealt over."""

    axis: int = -1
    cut: int = 0
    low: Node | None = None
    high: Node | None = None
    leaf: int = 0
    chunks: int = 1


def fit_tree(points: np.ndarray, rows_each: float, most: int, radius2: float) -> Node:
    """Median cuts over all components of a block until a leaf stands for ``most`` rows or cannot be cut to use.

    ``points`` is a sample of which each stands for ``rows_each`` rows. A leaf as narrow as the join's reach would hand
    all of its rows to both halves; it stays whole, and its rows are dealt over chunks.
    """
    numbers = iter(range(1 << 30))

    def grow(part: np.ndarray) -> Node:
        n = len(part) * rows_each
        if n > most and len(part) > 8:
            low, mid, high = np.quantile(part, (0.1, 0.5, 0.9), axis=0, method="nearest").astype(np.int64)
            axis = int(np.argmax(high - low))
            left = part[:, axis] < mid[axis]
            if (high - low)[axis] ** 2 > radius2 and left.any():
                return Node(axis, int(mid[axis]), grow(part[left]), grow(part[~left]))
        return Node(leaf=next(numbers), chunks=max(1, int(np.ceil(n / (2 * most)))))

    return grow(points)


def route(node: Node, points: np.ndarray, rows: np.ndarray, over: np.ndarray, guest: np.ndarray, radius2: float) -> Iterator[tuple]:
    """Leaf, rows and whether they are guests, for every leaf that a row is at home in or that is in its reach after that."""
    if not len(rows):
        return
    if node.low is None:
        yield node, rows, guest
        return
    gap = points[rows, node.axis].astype(np.float64) - node.cut
    low = gap < 0
    across = over.copy()
    across[:, node.axis] = np.maximum(across[:, node.axis], gap**2)
    near = across.sum(axis=1) <= radius2
    for child, mine, other in ((node.low, low, ~low & guest & near), (node.high, ~low, low & near)):
        for_them = np.concatenate([over[mine], across[other]])
        yield from route(child, points, np.concatenate([rows[mine], rows[other]]), for_them, np.concatenate([guest[mine], np.ones(other.sum(), bool)]), radius2)


def meetings(points: np.ndarray, home: np.ndarray, side: np.ndarray, radius2: float, seen: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within reach, at least one of them at home and of different sides if there are two.

    Rows are cut at medians into cells of up to CELL rows; a cell is compared with the rows of later cells that its
    bounding box can reach. ``seen`` gets the number of compared pairs.
    """
    n, points = len(points), points.astype(np.float32)
    order, stack, starts = np.arange(n), [(0, n)], []
    while stack:
        a, b = stack.pop()
        if b - a <= CELL:
            starts.append(a)
            continue
        part = points[order[a:b]]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        order[a:b] = order[a:b][np.argpartition(part[:, axis], (b - a) // 2)]
        stack += [(a, (a + b) // 2), ((a + b) // 2, b)]
    starts = np.array(sorted(starts), np.int64)
    stops = np.append(starts[1:], n)
    p, home, side = points[order], home[order], side[order]
    norms = (p * p).sum(axis=1)
    low, high = np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)
    homes = np.add.reduceat(home.astype(np.int64), starts)
    two = n > 0 and (side != side[0]).any()
    for c, (a, b) in enumerate(zip(starts.tolist(), stops.tolist(), strict=True)):
        gap = np.maximum(0, np.maximum(low[c:] - high[c], low[c] - high[c:]))
        meet = ((gap**2).sum(axis=1) <= radius2) & ((homes[c:] > 0) | (homes[c] > 0))
        later = a + np.flatnonzero(np.repeat(meet, (stops - starts)[c:]))
        if not homes[c]:
            later = later[home[later]]
        gap = np.maximum(0, np.maximum(p[later] - high[c], low[c] - p[later]))
        later = later[(gap**2).sum(axis=1) <= radius2]
        for at in range(0, len(later), 1 << 14):
            y = later[at : at + (1 << 14)]
            if seen is not None:
                seen[0] += (b - a) * len(y)
            near = norms[a:b, None] + norms[None, y] - 2 * (p[a:b] @ p[y].T) <= radius2
            i, j = np.nonzero(near)
            i, j = i + a, y[j]
            keep = (i < j) & (home[i] | home[j])
            if two:
                keep &= side[i] != side[j]
            yield order[i[keep]], order[j[keep]]


class Forest:
    """Which rows are joined; gives the links that join two trees."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
        pairs = np.stack([self.label[a], self.label[b]], axis=1)
        fresh = np.flatnonzero(pairs[:, 0] != pairs[:, 1])
        if not len(fresh):
            return
        _, at = np.unique(np.sort(pairs[fresh], axis=1), axis=0, return_index=True)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while x in root:
                x = root[x]
            return x

        for i in fresh[at].tolist():
            x, y = find(int(pairs[i, 0])), find(int(pairs[i, 1]))
            if x != y:
                root[max(x, y)] = min(x, y)
                yield int(a[i]), int(b[i])
        to = self.label.copy()
        for x in root:
            to[x] = find(x)
        self.label = to[self.label]


def by_dim(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, rows and matrix of the vectors of each length."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        yield dim, at, flat[(ends[at] - dim)[:, None] + np.arange(dim)]


def usable(vector: str) -> Column:
    """Whether a vector has components, all of them finite numbers and not all of them zero."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(F.col(vector), lambda x: x != 0)
    return F.coalesce(finite & (F.size(vector) > 0), F.lit(False))


def near_vectors(
    vectors: DataFrame, least_cos: float = 0.95, width: int = 8, leaf_rows: int = 32_768, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, n_links and component_id of every vector: links are pairs of other vectors with cosine >= ``least_cos``.

    Unit vectors are rotated, coded in one byte per component, and split into blocks of about ``width`` components. Two
    linked ones differ in some block by at most its share of the squared distance. Each block is range-joined: a tree of
    median cuts over all its components, fitted on a bounded sample and as deep as there are vectors, deals a row to the
    leaf it is at home in and to later leaves within its reach. Inside a leaf, cells of a few rows are compared with
    those that their bounding boxes reach. What meets is verified in the first block where it meets, so each link counts
    once: the bytes, with each vector's known distance from its bytes, tell links from others except close to the
    limit; there, whole vectors are fetched and their cosine is taken in double precision. A task gives counts per
    vector and links of a spanning forest, not its pairs. A leaf too narrow to be cut is dealt over chunks, and pairs of
    chunks go to different tasks. ``component_id`` is the least id that links reach.

    Equal vectors (told by 128 bits of hash) are one row that counts for all of its copies. Vectors that are null, zero
    or hold null or non-finite components link with nothing and are their own component. Only vectors of equal length
    are compared. Null ids are kept; repeated ids are vectors of their own. No rows give no rows; other columns are not
    read.
    """
    keys = ["k1", "k2"]
    hashed = vectors.select(
        F.col(vec_id).alias("vec_id"), F.when(usable(vector), F.col(vector)).alias("vec"), F.xxhash64(vector).alias("k1"), F.xxhash64(F.lit(1), vector).alias("k2")
    )

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                for dim, at, raw in by_dim(batch.column("vec")):
                    coded, off = in_bytes(rotated(raw))
                    rest = batch.select(["vec_id", *keys]).take(pa.array(at))
                    q = pa.array([row.tobytes() for row in coded], pa.binary())
                    yield pa.record_batch([*rest.columns, pa.array(np.full(len(at), dim, np.int32)), pa.array(off.astype(np.float32)), q], names=["vec_id", *keys, "dim", "off", "q"])

    id_type = hashed.schema["vec_id"].dataType.simpleString()
    coded = stored(hashed.filter("vec IS NOT NULL").mapInArrow(code, f"vec_id {id_type}, k1 long, k2 long, dim int, off float, q binary"))
    kinds = coded.groupBy(*keys).agg(F.min("vec_id").alias("first"), F.count("*").alias("weight"), F.max(F.struct("q", "off", "dim")).alias("c"))
    kinds = stored(kinds.select(F.monotonically_increasing_id().alias("v"), *keys, "first", "weight", "c.dim", "c.off", "c.q"))
    trees = fitted_trees(kinds, width, least_cos, leaf_rows)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, v, weight, off = (batch.column(c).to_numpy() for c in ("dim", "v", "weight", "off"))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                q = np.frombuffer(b"".join(batch.column("q").take(pa.array(at)).to_pylist()), np.int8).reshape(-1, dim)
                out = {c: [] for c in ("block", "leaf", "i", "j", "v", "weight", "off", "q", "home", "side")}
                for block, ((lo, hi), radius2) in enumerate(zip(blocks_of(dim, width), reach(dim, width, least_cos), strict=True)):
                    part = q[:, lo:hi]
                    n = len(part)
                    tree = trees.get((dim, block), Node())
                    for node, rows, guest in route(tree, part, np.arange(n), np.zeros((n, hi - lo)), np.zeros(n, bool), radius2):
                        side = v[at[rows]] % node.chunks
                        for i in range(node.chunks):
                            for j in range(i, node.chunks):
                                mine = (side == i) | (side == j)
                                these = rows[mine]
                                if len(these):
                                    for c, value in (("block", block), ("leaf", node.leaf), ("i", i), ("j", j), ("v", v[at[these]].tobytes())):
                                        out[c].append(value)
                                    for c, values in (("weight", weight[at[these]]), ("off", off[at[these]]), ("q", q[these]), ("home", ~guest[mine]), ("side", side[mine] == j)):
                                        out[c].append(values.tobytes())
                yield pa.record_batch(
                    [pa.array([dim] * len(out["block"]), pa.int32())]
                    + [pa.array(out[c], pa.int32()) for c in ("block", "leaf", "i", "j")]
                    + [pa.array(out[c], pa.binary()) for c in ("v", "weight", "off", "q", "home", "side")],
                    names=["dim", *out],
                )

    group = ["dim", "block", "leaf", "i", "j"]
    dealt = kinds.select("v", "weight", "dim", "off", "q").mapInArrow(
        deal, "dim int, block int, leaf int, i int, j int, v binary, weight binary, off binary, q binary, home binary, side binary"
    )
    limit = float(np.sqrt(2 - 2 * least_cos))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sorted_tables(batches, group):
            dim, block = table["dim"][0].as_py(), table["block"][0].as_py()
            kinds_of = {"v": np.int64, "weight": np.int64, "off": np.float32, "q": np.int8, "home": bool, "side": bool}
            v, weight, off, q, home, side = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in kinds_of.items())
            q, bounds, radii = q.reshape(-1, dim), blocks_of(dim, width), reach(dim, width, least_cos)
            lo, hi = bounds[block]
            counts, forest, edges, unsure = np.zeros(len(v), np.int64), Forest(len(v)), [], []
            for x, y in meetings(q[:, lo:hi], home, side, radii[block]):
                for at in range(0, len(x), 1 << 15):
                    a, b = x[at : at + (1 << 15)], y[at : at + (1 << 15)]
                    apart = (q[a].astype(np.int32) - q[b]) ** 2
                    first = np.ones(len(a), bool)
                    for (s, t), radius2 in zip(bounds[:block], radii[:block], strict=True):
                        first &= apart[:, s:t].sum(axis=1) > radius2
                    a, b, far = a[first], b[first], np.sqrt(apart[first].sum(axis=1)) / scale(dim)
                    doubt = off[a] + off[b]
                    sure = far + doubt <= limit * (1 - 1e-6)
                    open_ = ~sure & (far - doubt <= limit * (1 + 1e-6))
                    unsure.append(np.stack([v[a[open_]], v[b[open_]]], axis=1))
                    a, b = a[sure], b[sure]
                    np.add.at(counts, a, weight[b])
                    np.add.at(counts, b, weight[a])
                    edges.extend(forest.join(a, b))
            some, ends = np.flatnonzero(counts), np.array(edges, np.int64).reshape(-1, 2)
            pairs = np.concatenate([np.zeros((0, 2), np.int64), *unsure])
            n = (len(some), len(ends), len(pairs))
            yield pa.record_batch(
                [pa.array(np.repeat(np.array([0, 1, 2], np.int32), n)), pa.array(np.concatenate([v[some], v[ends[:, 0]], pairs[:, 0]]))]
                + [pa.array(np.concatenate([counts[some], v[ends[:, 1]], pairs[:, 1]]))],
                names=["what", "v", "other"],
            )

    found = stored(dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(compare, "what int, v long, other long"))
    verified = stored(verified_links(found.filter("what = 2").select(F.col("v").alias("a"), F.col("other").alias("b")), kinds, hashed, least_cos))
    both = verified.select(F.col("a").alias("v"), F.col("b_weight").alias("n")).unionByName(verified.select(F.col("b").alias("v"), F.col("a_weight").alias("n")))
    counted = found.filter("what = 0").select("v", F.col("other").alias("n")).unionByName(both)
    links = counted.groupBy("v").agg(F.sum("n").alias("links"))
    ends = found.filter("what = 1").select(F.col("v").alias("a"), F.col("other").alias("b")).unionByName(verified.select("a", "b"))
    groups = components(ends).withColumnRenamed("node", "v")
    known = kinds.select("v", *keys, "first", "weight").join(links, "v", "left").join(groups, "v", "left").withColumn("component", F.coalesce("component", "v"))
    known = stored(known)
    least = stored(known.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("n")))
    judged = spread_join(known, least, ["component"], "n")
    judged = stored(judged.select(*keys, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id", "weight"))
    out = spread_join(coded.select("vec_id", *keys), judged, keys, "weight").select("vec_id", "n_links", "component_id")
    alone = hashed.filter("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone)


def fitted_trees(kinds: DataFrame, width: int, least_cos: float, leaf_rows: int) -> dict[tuple[int, int], Node]:
    """A tree for each block of each length that more than ``leaf_rows`` vectors have, from a sample of at most about
    SAMPLE vectors in all."""
    sizes = {r["dim"]: r["n"] for r in kinds.groupBy("dim").agg(F.count("*").alias("n")).filter(F.col("n") > leaf_rows).collect()}
    if not sizes:
        return {}
    share = min(1.0, SAMPLE / sum(sizes.values()))
    few = F.pmod(F.col("k1"), F.lit(1_000_003)) < int(share * 1_000_003)
    sample = kinds.filter(F.col("dim").isin(list(sizes)) & few).select("dim", "q").toPandas()
    trees = {}
    for dim, rows in sample.groupby("dim")["q"]:
        points = np.frombuffer(b"".join(rows), np.int8).reshape(-1, dim).astype(np.int64)
        for block, ((lo, hi), radius2) in enumerate(zip(blocks_of(dim, width), reach(dim, width, least_cos), strict=True)):
            trees[dim, block] = fit_tree(points[:, lo:hi], sizes[dim] / len(points), leaf_rows, radius2)
    return trees


def verified_links(pairs: DataFrame, kinds: DataFrame, hashed: DataFrame, least_cos: float) -> DataFrame:
    """The pairs (``a``, ``b``) whose whole vectors have the cosine, in double precision, with both weights."""
    named = pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v"))).distinct().join(kinds.select("v", "k1", "k2", "weight"), "v")
    whole = hashed.join(named, ["k1", "k2"]).groupBy("v").agg(F.any_value("vec").alias("vec"), F.any_value("weight").alias("weight"))
    whole = checkpointed(whole)
    sides = [whole.select(F.col("v").alias(s), F.col("vec").alias(f"{s}_vec"), F.col("weight").alias(f"{s}_weight")) for s in ("a", "b")]

    def cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, q = ([np.array(v, np.float64) for v in batch.column(c).to_pylist()] for c in ("a_vec", "b_vec"))
            cos = np.array([(x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum()) for x, y in zip(p, q, strict=True)])
            yield batch.select(["a", "b", "a_weight", "b_weight"]).filter(pa.array(cos >= least_cos))

    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(cosines, "a long, b long, a_weight long, b_weight long")


def sorted_tables(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table for each run of equal keys, from batches sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        cuts = [0, *(np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
