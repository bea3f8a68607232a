"""Stored tables that can be rewritten in part: scoped deletes, re-seeds and updates, and appends that may be repeated.

A ``ScopedTable`` is a Parquet folder with one folder per value of its scope columns. A change reads and replaces only
the scopes that it touches, by dynamic partition overwrite; the files of all others stay as they are. A ``RunTable`` has
one folder per run; a run counts once its commit marker is there, and a repeated run replaces nothing and adds nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from flowgauge.sources.tables import keep_after_delete, update_where

MARKER = "_SUCCESS"  # written by Spark's committer when all files of a write are in place


def hadoop_path(spark: SparkSession, path: str):
    """The file system that holds a path, and the path on it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop_path(spark, path)
    return fs.exists(where)


@dataclass(frozen=True)
class Change:
    """What a rewrite did: rows that went, rows of the table that were there before and stayed or changed in place."""

    deleted: int
    remaining: int
    scopes: tuple[Row, ...]


@dataclass(frozen=True)
class ScopedTable:
    """A table laid out by ``scope``. ``schema`` lists all columns, the scope's too."""

    spark: SparkSession
    path: str
    schema: str
    scope: tuple[str, ...]

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def create(self, rows: DataFrame) -> ScopedTable:
        """Write the whole table. Rows are rebalanced by scope: a hot scope gets as many writers as its size needs."""
        self._write(rows, "overwrite", "static")
        return self

    def _write(self, rows: DataFrame, mode: str, overwrite: str) -> None:
        laid_out = rows.hint("rebalance", *[F.col(c) for c in self.scope])
        laid_out.write.partitionBy(*self.scope).mode(mode).option("partitionOverwriteMode", overwrite).parquet(self.path)

    def _is_one_of(self, scopes: Sequence[Row]) -> Column:
        """A predicate on scope columns alone, so that other folders are neither listed nor read."""
        out = F.lit(False)
        for s in scopes:
            one = F.lit(True)
            for c in self.scope:
                one = one & F.col(c).eqNullSafe(F.lit(s[c]))
            out = out | one
        return out

    def _rewrite(self, rows: DataFrame, touched: Sequence[Row], left: set[tuple]) -> None:
        """Replace the touched scopes by ``rows``, which lie in the scopes ``left``. The others lose their folders."""
        if not touched:
            return
        self._write(rows, "overwrite", "dynamic")
        fs, root = hadoop_path(self.spark, self.path)
        names = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for s in touched:
            if tuple(s) not in left:
                folder = self.path
                for c in self.scope:
                    folder += "/" + names.getPartitionPathString(c, None if s[c] is None else str(s[c]))
                fs.delete(hadoop_path(self.spark, folder)[1], True)
        self.spark.catalog.refreshByPath(self.path)

    def _scopes_of(self, rows: DataFrame) -> list[Row]:
        """The scopes of some rows; at most one row per folder of the table."""
        return rows.select(*self.scope).distinct().collect()

    def _counted(self, hit: Column) -> list[Row]:
        """Per scope the rows hit and all rows; one row per folder of the table."""
        return self.read().groupBy(*self.scope).agg(F.count_if(hit).alias("_hit"), F.count("*").alias("_all")).collect()

    def _key(self, r: Row) -> Row:
        return Row(*self.scope)(*[r[c] for c in self.scope])

    def delete(self, condition: Column) -> Change:
        """Delete the rows that satisfy the condition; a row for which it is unknown (NULL) stays.

        One pass counts per scope. Only scopes that lose rows are read again and replaced. Doing it twice is doing it once.
        """
        counts = self._counted(F.coalesce(condition, F.lit(False)))
        touched = [self._key(r) for r in counts if r["_hit"]]
        left = {tuple(self._key(r)) for r in counts if r["_all"] > r["_hit"]}
        self._rewrite(keep_after_delete(self.read().filter(self._is_one_of(touched)), condition), touched, left)
        gone = sum(r["_hit"] for r in counts)
        return Change(gone, sum(r["_all"] for r in counts) - gone, tuple(touched))

    def replace(self, condition: Column, rows: DataFrame) -> Change:
        """Re-seed: rows that satisfy the condition go, ``rows`` come. Running it again with the same rows changes nothing.

        The new rows must satisfy the condition too, or a repeated run would add them again.
        """
        if not rows.filter(~F.coalesce(condition, F.lit(False))).isEmpty():
            raise ValueError("rows outside of the scope that is replaced")
        counts = self._counted(F.coalesce(condition, F.lit(False)))
        new = {tuple(r): r for r in self._scopes_of(rows)}
        touched = list(({tuple(self._key(r)): self._key(r) for r in counts if r["_hit"]} | new).values())
        left = {tuple(self._key(r)) for r in counts if r["_all"] > r["_hit"]} | set(new)
        kept = keep_after_delete(self.read().filter(self._is_one_of(touched)), condition)
        self._rewrite(kept.unionByName(rows.select(*kept.columns)), touched, left)
        gone = sum(r["_hit"] for r in counts)
        return Change(gone, sum(r["_all"] for r in counts) - gone, tuple(touched))

    def update(self, condition: Column, changes: Mapping[str, Column]) -> Change:
        """Set columns where the condition is true; a change of a scope column moves the row to its new folder.

        All right-hand sides see the old row. ``deleted`` counts the rows changed.
        """
        hit = F.coalesce(condition, F.lit(False))
        counts = self._counted(hit)
        targets = {tuple(r): r for r in self._scopes_of(update_where(self.read().filter(hit), condition, changes))}
        touched = list(({tuple(self._key(r)): self._key(r) for r in counts if r["_hit"]} | targets).values())
        left = {tuple(self._key(r)) for r in counts if r["_all"] > r["_hit"]} | set(targets)
        self._rewrite(update_where(self.read().filter(self._is_one_of(touched)), condition, changes), touched, left)
        changed = sum(r["_hit"] for r in counts)
        return Change(changed, sum(r["_all"] for r in counts) - changed, tuple(touched))


@dataclass(frozen=True)
class RunTable:
    """A table that runs append to: one folder a run, which counts when its write has been committed."""

    spark: SparkSession
    path: str
    schema: str

    def folder(self, run: str) -> str:
        return f"{self.path}/run={run}"

    def append(self, rows: DataFrame, run: str) -> bool:
        """Append under a run id. A committed run is left alone; what a failed one left behind is replaced."""
        if exists(self.spark, f"{self.folder(run)}/{MARKER}"):
            return False
        rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(self.folder(run))
        return True

    def runs(self) -> list[str]:
        """The committed runs, in order of their ids."""
        fs, root = hadoop_path(self.spark, f"{self.path}/run=*/{MARKER}")
        return sorted(f.getPath().getParent().getName().removeprefix("run=") for f in fs.globStatus(root) or [])

    def read(self) -> DataFrame:
        """The rows of all committed runs, with the column ``run``."""
        folders = [self.folder(r) for r in self.runs()]
        if not folders:
            return self.spark.createDataFrame([], f"{self.schema}, run string")
        return self.spark.read.schema(f"{self.schema}, run string").option("basePath", self.path).parquet(*folders)


def export_snapshot(df: DataFrame, path: str, scope: str) -> bool:
    """Snapshot a table as one folder per scope value, once: a committed snapshot is left alone, the rest of a failed one replaced.

    Rows are rebalanced by scope: small scopes share a task, and a large one is split over as many writers as its size needs.
    """
    if exists(df.sparkSession, f"{path}/{MARKER}"):
        return False
    df.hint("rebalance", F.col(scope)).write.partitionBy(scope).mode("overwrite").parquet(path)
    return True
