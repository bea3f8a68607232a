"""Stored tables: only the touched scopes are rewritten, and repeated runs change nothing."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from flowgauge.sources.stores import RunTable, ScopedTable, export_snapshot

SCHEMA = "id BIGINT, v STRING, day STRING, org STRING"


def files(path) -> dict[str, float]:
    found = {}
    for folder, _, names in os.walk(path):
        found |= {os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


@pytest.fixture()
def table(spark, tmp_path):
    rows = [(i, f"v{i}", f"d{i % 4}" if i % 9 else None, f"o/{i % 2} x") for i in range(40)]
    return ScopedTable(spark, str(tmp_path / "t"), SCHEMA, ("day", "org")).create(spark.createDataFrame(rows, SCHEMA))


def rows_of(table):
    return sorted((tuple(r) for r in table.read().select("id", "v", "day", "org").collect()), key=repr)


def test_delete_replaces_the_touched_folders_only(table):
    before, rows = files(table.path), rows_of(table)
    gone = lambda r: r[2] == "d1" and r[0] % 3 == 0
    condition = (F.col("day") == "d1") & (F.col("id") % 3 == 0)
    change = table.delete(condition)
    assert (change.deleted, change.remaining) == (sum(map(gone, rows)), sum(not gone(r) for r in rows))
    assert rows_of(table) == [r for r in rows if not gone(r)]
    after = files(table.path)
    same = {f: t for f, t in before.items() if "day=d1" not in f}
    assert same and all(after[f] == t for f, t in same.items())
    assert not any(f in after for f in before if "day=d1" in f)
    again = table.delete(condition)
    assert (again.deleted, again.remaining) == (0, change.remaining) and files(table.path) == after


def test_delete_of_whole_scopes_removes_their_folders(table):
    rows = rows_of(table)
    table.delete(F.col("org") == "o/1 x")
    assert rows_of(table) == [r for r in rows if r[3] != "o/1 x"] and not any("o%2F1" in f for f in files(table.path))
    table.delete(F.col("day").isNull())
    assert rows_of(table) == [r for r in rows if r[3] != "o/1 x" and r[2] is not None]
    table.delete(F.lit(True))
    assert table.read().count() == 0


def test_a_reseed_can_be_repeated_and_add_scopes(spark, table):
    rows = rows_of(table)
    new = spark.createDataFrame([(100, "n", "d2", "o/0 x"), (101, "n", "d9", "o/0 x")], SCHEMA)
    want = sorted([r for r in rows if r[2] != "d2"] + [tuple(r) for r in new.collect()], key=repr)
    for _ in range(2):
        table.replace(F.col("day").isin("d2", "d9"), new)
        assert rows_of(table) == want
    with pytest.raises(ValueError, match="outside"):
        table.replace(F.col("day") == "d2", new)
    untouched = {f for f in files(table.path) if "day=d0" in f}
    assert untouched


def test_update_moves_rows_between_scopes(table):
    rows = rows_of(table)
    change = table.update(F.col("id") < 10, {"day": F.lit("d3"), "v": F.concat("v", F.lit("!"))})
    assert change.deleted == 10
    assert rows_of(table) == sorted([(i, v + "!", "d3", o) if i < 10 else (i, v, d, o) for i, v, d, o in rows], key=repr)


def test_runs_count_once_and_only_when_committed(spark, tmp_path):
    table = RunTable(spark, str(tmp_path / "r"), "id BIGINT")
    assert table.read().count() == 0
    assert table.append(spark.range(3), "a") and table.append(spark.range(2), "b")
    assert not table.append(spark.range(3), "a")
    os.makedirs(tmp_path / "r" / "run=c")
    spark.range(9).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(str(tmp_path / "r" / "run=c"))
    assert table.runs() == ["a", "b"] and table.read().count() == 5
    assert table.append(spark.range(1), "c") and table.read().filter("run = 'c'").count() == 1


def test_a_snapshot_is_taken_once(spark, tmp_path):
    rows = spark.range(8).selectExpr("id", "id % 2 AS s")
    assert export_snapshot(rows, str(tmp_path / "s"), "s") and not export_snapshot(rows, str(tmp_path / "s"), "s")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 8
