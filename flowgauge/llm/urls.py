"""URL rules by a cascade of Bloom filters, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm.common import stored

BITMAP = 1 << 15  # bits of one bitmap of bitmap_construct_agg


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str = "/"

    @property
    def key(self) -> str:
        return self.host + self.path

    @property
    def shape(self) -> tuple[int, int]:
        """Number of labels of the host and of characters of the path."""
        return self.host.count(".") + 1, len(self.path)


def url_host(url: Column) -> Column:
    """What stands after the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.substring_index(F.substring_index(F.substring_index(_after_scheme(url), "/", 1), "?", 1), "#", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ? or # or the end; empty for null or without ://."""
    bare = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    slash = F.locate("/", bare)
    return F.coalesce(F.when(slash > 0, bare.substr(slash, F.length(bare))), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def candidate(host: Column, path: Column, shape: tuple[int, int]) -> Column:
    """The only key of that shape that could fit: the host's last labels and the path's first characters, or null."""
    labels, chars = shape
    enough = (F.length(host) - F.length(F.replace(host, F.lit("."))) >= labels - 1) & (F.length(path) >= chars)
    return F.when(enough & (F.length(host) > 0), F.concat(F.substring_index(host, ".", -labels), path.substr(1, chars)))


@dataclass(frozen=True)
class Level:
    n_bits: int
    n_hashes: int
    seed: int
    bits: bytes = b""  # bit p is bit p % 8 of byte p div 8

    def places(self, key: Column) -> list[Column]:
        """The key's bit numbers."""
        return [F.pmod(F.xxhash64(F.lit(self.seed + i), key), F.lit(self.n_bits)) for i in range(self.n_hashes)]

    def holds(self, key: Column) -> Column:
        bits = F.lit(self.bits)  # one value of the plan, which all tests share
        out = F.lit(True)
        for p in self.places(key):
            byte = F.conv(F.hex(F.substring(bits, (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            out = out & (F.getbit(byte, (p % 8).cast("int")) == 1)
        return out


def build_level(keys: DataFrame, n: int, seed: int, rate: float) -> Level:
    """A Bloom filter over the ``n`` rows of the column ``key``: bitmaps are made and merged in Spark, and only the finished bits reach the driver."""
    n_hashes = max(1, round(-math.log2(rate)))
    level = Level(max(8, math.ceil(n * n_hashes / math.log(2))), n_hashes, seed)
    places = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("p"))
    maps = places.groupBy(F.floor(F.col("p") / BITMAP).alias("at")).agg(F.bitmap_construct_agg(F.col("p") % BITMAP).alias("bits"))
    bits = bytearray(-(-level.n_bits // 8))
    for row in maps.collect():  # one row for 32768 bits
        start = row["at"] * BITMAP // 8
        part = row["bits"][: len(bits) - start]
        bits[start : start + len(part)] = part
    return replace(level, bits=bytes(bits))


@dataclass(frozen=True)
class Cascade:
    """Levels by turns of listed keys and of others that the level before takes for listed ones."""

    levels: tuple[Level, ...]

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level that does not hold it decides."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            out = F.when(level.holds(key), out).otherwise(F.lit(i % 2 == 1))
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, rate: float = 0.1) -> Cascade:
    """Exact on every key of ``universe`` and ``listed`` (columns ``key``, distinct, not null).

    Level 0 holds the listed keys. Each next level holds the keys of the other kind that the levels so far get wrong,
    until none is left. Level 0 is made so fine that it takes in about as many others as there are listed keys, at most
    a share of ``rate``; so all levels together grow with the listed keys, times the logarithm of the universe over
    them, and not with the universe. There is no limit to the list. The bits go to the tasks with the plan: 1.44 bits a
    listed key for each halving of level 0's share. No listed keys give a cascade without levels, which lists nothing.
    """
    others = stored(universe.join(listed, "key", "left_anti"))
    sides, levels = [listed, others], []
    n_others = others.count()
    while (n := sides[len(levels) % 2].count()) > 0:
        k = len(levels) % 2
        share = rate if levels else min(rate, n / max(n_others, 1))
        levels.append(build_level(sides[k], n, 1000 * len(levels), share))
        # Only what the new level takes in of the other side goes on.
        sides[1 - k] = sides[1 - k].filter(levels[-1].holds(F.col("key")))
    return Cascade(tuple(levels))


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule and verdict of every url.

    A rule fits its host and all subdomains if the url's path starts with its path. The longest rule text wins, then the
    longer host. Rules are looked up in one cascade for blocked and one for allowed keys, built over all keys that the
    pages' urls can ask for, so that the answers are exact; the urls are not joined with anything. A url that no rule
    fits, also a null one or one without ``://``, gets ``default`` and a null rule. A key both allowed and blocked is
    blocked. Repeated rows are judged each. No pages give no rows; other columns are not read.
    """
    spark: SparkSession = pages.sparkSession
    shapes = sorted({r.shape for r in rules}, reverse=True)
    slim = pages.select(F.col(page_id).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    if not shapes:
        return slim.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    asked = F.array(*[candidate(F.col("host"), F.col("path"), s) for s in shapes])
    universe = stored(slim.select(F.explode(asked).alias("key")).filter("key IS NOT NULL").distinct())

    def cascade(action: str) -> Cascade:
        keys = sorted({r.key for r in rules if r.action == action})
        listed = spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in keys]).cast("array<string>")).alias("key"))
        return build_cascade(listed, universe)

    blocked, allowed = cascade("block"), cascade("allow")
    keyed = slim.withColumns({f"_k{i}": candidate(F.col("host"), F.col("path"), s) for i, s in enumerate(shapes)})
    found = []
    for i, (labels, _) in enumerate(shapes):
        key = F.col(f"_k{i}")
        verdict = F.when(blocked.listed(key), "block").when(allowed.listed(key), "allow")
        found.append(F.when(key.isNotNull() & verdict.isNotNull(), F.struct(F.length(key).alias("n"), F.lit(labels).alias("labels"), key.alias("rule"), verdict.alias("verdict"))))
    best = F.greatest(*found) if len(found) > 1 else found[0]
    picked = keyed.select("page_id", "host", "path", best.alias("best"))
    return picked.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
