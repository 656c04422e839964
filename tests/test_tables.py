"""Durable keyed tables: changes by bucket, versions, interrupted and concurrent writers."""

import os

import pytest
from pyspark.sql import functions as F

from rivulet.operators import apply_changes, kt_check_and_put, kt_put, kt_remove, kt_remove_all, settle_changes
from rivulet.session import work_path
from rivulet.sources import KeyedTable, TableConflict, table_exists
from rivulet.sources import tables

CELLS = "row_key string, family string, qualifier string, value string"


@pytest.fixture
def cells(spark):
    return spark.range(60).selectExpr("cast(id as string) row_key", "'f' family", "'q' qualifier", "cast(id * 2 as string) value")


@pytest.fixture
def table(spark, cells):
    made = KeyedTable.create(spark, work_path(spark, "keyed"), CELLS, ["row_key"], buckets=8)
    made.replace(cells)
    return made


def contents(df):
    return sorted(tuple(r) for r in df.collect())


def files(table):
    return {
        os.path.join(d, f) for d, _, names in os.walk(os.path.join(table.path, "data")) for f in names if f.endswith(".parquet")
    }


def test_put_remove_and_clear_last(spark, table, cells):
    new = spark.createDataFrame([("5", "f", "q", "new"), ("x", "g", "q", "y"), (None, "f", "q", "z")], CELLS)
    table.update(lambda old: kt_put(old, new), touching=new)
    assert contents(KeyedTable.open(spark, table.path).read().na.drop()) == contents(kt_put(cells, new).na.drop())
    assert table.read().count() == 62
    gone = spark.createDataFrame([("5",), ("6",), ("nobody",)], "row_key string")
    removed = table.update(lambda old: kt_remove(old, gone), touching=gone)
    assert {r.row_key: r.existed for r in removed.results.collect()} == {"5": True, "6": True, "nobody": False}
    assert KeyedTable.open(spark, table.path).read().count() == 60
    kt_remove_all(table)
    again = KeyedTable.open(spark, table.path)
    assert again.read().count() == 0 and again.read().columns == cells.columns and again.version == table.version


def test_a_change_rewrites_only_the_buckets_it_touches(spark, table):
    before = files(table)
    one = spark.createDataFrame([("7", "f", "q", "new")], CELLS)
    assert len(table.touched(one)) == 1
    table.update(lambda old: kt_put(old, one), touching=one)
    new = files(table) - before
    assert new and {os.path.basename(os.path.dirname(f)) for f in new} == {f"_rv_bucket={table.touched(one)[0]}"}
    # a look-up reads the one bucket only
    read = table.lookup(one.select("row_key"))
    assert read.first()["value"] == "new" and len(read.inputFiles()) <= len(new)
    with pytest.raises(ValueError, match="does not touch"):
        table.update(lambda old: old.withColumn("row_key", F.concat("row_key", F.lit("!"))), touching=one)
    assert table.read().filter("value = 'new'").count() == 1


def test_readers_keep_their_version_until_vacuum(spark, table, cells):
    old = KeyedTable.open(spark, table.path)
    rows, version = old.read(), old.version
    new = spark.createDataFrame([("7", "f", "q", "new")], CELLS)
    table.update(lambda x: kt_put(x, new), touching=new)
    table.clear()
    assert contents(rows) == contents(cells) == contents(KeyedTable.open(spark, table.path, version).read())
    assert table.vacuum() > 0 and not files(table)
    with pytest.raises(FileNotFoundError):
        KeyedTable.open(spark, table.path, version)
    assert table.read().count() == 0


def test_vacuum_keeps_what_the_kept_versions_hold(spark, table, cells):
    new = spark.createDataFrame([("7", "f", "q", "new")], CELLS)
    for _ in range(3):
        table.update(lambda x: kt_put(x, new), touching=new)
    table.vacuum(keep=1)
    assert contents(KeyedTable.open(spark, table.path).read()) == contents(kt_put(cells, new))


def test_an_interrupted_write_leaves_the_old_version(spark, table, cells, monkeypatch):
    new = spark.createDataFrame([("7", "f", "q", "new")], CELLS)
    version = table.version
    with pytest.raises(Exception, match="broken off"):
        table.update(lambda x: kt_put(x, new).withColumn("value", F.raise_error(F.lit("broken off")).cast("string")), touching=new)
    assert KeyedTable.open(spark, table.path).version == version == table.version
    # the data is there, the version is not: as if the driver were lost in between
    monkeypatch.setattr(tables, "rename_new", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.update(lambda x: kt_put(x, new), touching=new)
    monkeypatch.undo()
    again = KeyedTable.open(spark, table.path)
    assert again.version == version and contents(again.read()) == contents(cells)
    again.update(lambda x: kt_put(x, new), touching=new)
    assert contents(KeyedTable.open(spark, table.path).read()) == contents(kt_put(cells, new))


def test_the_second_of_two_writers_fails(spark, table, cells):
    other = KeyedTable.open(spark, table.path)
    table.replace(cells.limit(3))
    with pytest.raises(TableConflict):
        other.replace(cells.limit(5))
    assert KeyedTable.open(spark, table.path).read().count() == 3
    with pytest.raises(TableConflict):
        KeyedTable.create(spark, table.path, CELLS, ["row_key"])


def test_check_and_put_through_the_table(spark, table):
    requests = spark.createDataFrame(
        [(1, "7", "f", "q", "14", "a"), (2, "7", "f", "q", "a", "b"), (3, "7", "f", "q", "14", "c"), (4, "n", "f", "q", None, "d")],
        "no int, row_key string, family string, qualifier string, expected string, value string",
    )
    done = table.update(lambda x: kt_check_and_put(x, requests, ["no"]), touching=requests)
    assert {r.no: r.outcome for r in done.results.collect()} == {1: "put", 2: "put", 3: "refused", 4: "put"}
    found = {r.row_key: r.value for r in KeyedTable.open(spark, table.path).read().collect()}
    assert found["7"] == "b" and found["n"] == "d" and found["8"] == "16"


def test_changes_through_the_table(spark):
    made = KeyedTable.create(spark, work_path(spark, "keyed"), "id bigint, name string, n int", ["id"], buckets=4)
    made.replace(spark.range(20).selectExpr("id", "'old' as name", "cast(id as int) as n"))
    changes = spark.createDataFrame([
        ('{"table":"t","op_type":"U","pos":"1","before":{"id":3},"after":{"id":3,"name":"new"}}',),
        ('{"table":"t","op_type":"D","pos":"2","before":{"id":4}}',),
        ('{"table":"t","op_type":"I","pos":"3","after":{"id":99,"n":7}}',),
        ('{"table":"t","op_type":"U","pos":"4","before":{"id":1000},"after":{"name":"x"}}',),
    ], "content string")
    touching = spark.createDataFrame([(3,), (4,), (99,), (1000,)], "id bigint")
    done = made.update(lambda old: settle_changes(old, changes, ["id"]), touching=touching)
    found = {r.id: (r.name, r.n) for r in KeyedTable.open(spark, made.path).read().collect()}
    assert len(found) == 20 and found[3] == ("new", 3) and 4 not in found and found[99] == (None, 7) and found[5] == ("old", 5)
    assert [r.failure_reason for r in done.rejected.collect()] == ["there is no such row"]
    plain = apply_changes(KeyedTable.open(spark, made.path, 2).read(), changes, ["id"])
    assert contents(plain.fillna("")) == contents(made.read().fillna(""))


def test_opening_and_creating(spark):
    path = work_path(spark, "keyed")
    assert not table_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        KeyedTable.open(spark, path)
    with pytest.raises(ValueError):
        KeyedTable.create(spark, path, CELLS, ["nothing"])
    KeyedTable.create(spark, path, CELLS, ["row_key"])
    assert table_exists(spark, path) and KeyedTable.open(spark, path).read().count() == 0


def test_the_keys_that_a_query_touches_are_told_without_its_records(spark, sf_dir, monkeypatch):
    from rivulet.plans.inputs import order_changes
    from rivulet.plans.queries_tables import changes_through_a_table

    asked, touched = [], KeyedTable.touched
    monkeypatch.setattr(KeyedTable, "touched", lambda self, rows: asked.append(rows) or touched(self, rows))
    changes_through_a_table(spark, sf_dir)
    (rows,) = asked
    assert "to_json" not in rows._jdf.queryExecution().optimizedPlan().toString()
    changes = order_changes(spark, sf_dir)
    keys = changes.select("o_orderkey").union(changes.select(-F.col("o_orderkey") - 1)).distinct()
    assert contents(rows.distinct()) == contents(keys)
