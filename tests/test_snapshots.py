"""Versioned tables: history, as-of, update, restore, change feed."""

import tempfile

from pyspark.sql import functions as F

from smelter.operators.snapshots import SnapshotTable, changes


def test_versions_history_restore(spark):
    t = SnapshotTable(spark, tempfile.mkdtemp(prefix="snap-", dir="/tmp"))
    df = spark.createDataFrame([(1, True), (2, False), (3, True)], "k int, flag boolean")
    assert t.write(df) == 0
    assert t.update("flag", F.lit(False), F.col("flag")) == 1
    assert t.read().filter("flag").count() == 0
    assert t.read(0).filter("flag").count() == 2
    assert t.restore(0) == 2
    assert t.read().filter("flag").count() == 2
    hist = [(r.version, r.operation, r.rows) for r in t.history().orderBy("version").collect()]
    assert hist == [(0, "WRITE", 3), (1, "UPDATE flag", 3), (2, "RESTORE 0", 3)]


def test_changes_insert_update_delete(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    got = {(r.k, r.change_type) for r in changes(old, new, ["k"]).collect()}
    assert got == {(2, "update"), (3, "delete"), (4, "insert")}


def test_changes_see_null_moves_new_columns_and_null_keys(spark):
    schema = "k int, a double, b double"
    old = spark.createDataFrame([(1, None, 5.0), (2, 1.0, 1.0), (3, 1.0, 1.0), (None, 1.0, 1.0)], schema)
    new = spark.createDataFrame([(1, 5.0, None), (2, 1.0, 1.0), (4, 1.0, 1.0), (None, 1.0, 2.0)], schema)
    got = {(r.k, r.change_type) for r in changes(old, new, ["k"]).collect()}
    assert got == {(1, "update"), (3, "delete"), (4, "insert"), (None, "update")}
    wider = old.selectExpr("*", "CASE WHEN k = 2 THEN 7 END AS c")
    assert [(r.k, r.change_type) for r in changes(old, wider, ["k"]).collect()] == [(2, "update")]


def test_unreadable_history_is_an_error_and_versions_are_not_overwritten(spark):
    import os
    import tempfile

    import pytest

    root = tempfile.mkdtemp(prefix="snap-", dir="/tmp")
    table = SnapshotTable(spark, root)
    df = spark.range(5)
    assert table.write(df) == 0
    other = SnapshotTable(spark, root)
    assert other.write(df.limit(1)) == 1 and table.write(df.limit(2)) == 2
    assert [SnapshotTable(spark, root).read(v).count() for v in (0, 1, 2)] == [5, 1, 2]
    with open(os.path.join(root, "_history", "part-broken.parquet"), "w") as file:
        file.write("not a parquet file")
    with pytest.raises(Exception):
        SnapshotTable(spark, root).write(df)
    assert spark.read.parquet(os.path.join(root, "version=0")).count() == 5
