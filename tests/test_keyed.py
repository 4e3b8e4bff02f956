"""Tables kept by key: what a change reads and writes, and what a lost driver leaves."""

import os

import pytest
from pyspark.sql import functions as F

from tagloom.sources import io
from tagloom.sources.keyed import KeyedTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


def files(table):
    return {os.path.join(d, f) for d, _, names in os.walk(table.rows_path) for f in names if f.endswith(".parquet")}


def numbers(spark, n, value="old"):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(value).alias("v"))


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def test_only_touched_buckets_are_read_and_written(spark, path):
    table = KeyedTable(spark, path, ["k"], buckets=50)
    table.upsert(numbers(spark, 10_000))
    before = files(table)
    change = spark.createDataFrame([(k, "new") for k in range(0, 10_000, 1000)], "k int, v string")  # another integer type
    plan = table.touched(change)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan
    buckets = {os.path.basename(os.path.dirname(f)) for f in table.touched(change).inputFiles()}
    touched = {f"_bucket={b}" for b in table._touched(table._as_stored(change))}
    read = {f"_bucket={r[0]}" for r in table.touched(change).select(F.regexp_extract(F.input_file_name(), "_bucket=([0-9]+)", 1)).distinct().collect()}
    assert read == touched and 1 <= len(touched) <= 10 and buckets >= touched
    table.upsert(change)
    after = files(table)
    assert {os.path.basename(os.path.dirname(f)) for f in before ^ after} == touched  # all other files are the same ones
    assert table.read().count() == 10_000 and table.read().filter("v = 'new'").count() == 10


def test_equal_to_the_upsert_of_whole_tables(spark, path):
    table, want = KeyedTable(spark, path, ["a", "b"], buckets=7), None
    rules = {"n": "greatest", "s": "keep"}
    for step in range(4):
        data = [(i % 5 if i % 4 else None, f"b{(i * step) % 3}", i * (4 - step), f"s{step}") for i in range(step, 30)]
        source = spark.createDataFrame(data, "a int, b string, n int, s string")
        order = [F.col("n").desc()]
        want = io.latest_per_key(source, ["a", "b"], order) if want is None else io.upsert(want, source, ["a", "b"], rules, order)
        want = spark.createDataFrame(want.collect(), want.schema)
        table.upsert(source, rules, order)
        assert rows(table.read()) == rows(want)
    table.upsert(source, rules, order)  # again: nothing changes
    assert rows(KeyedTable(spark, path).read()) == rows(want)


def test_update_or_insert(spark, path):
    table = KeyedTable(spark, path, ["k"], buckets=4)
    table.create(spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), (None, 3, "y")], "k string, n int, created_at string"))
    table.update_or_insert(spark.createDataFrame([("a", 7), ("b", 8), (None, 9)], "k string, n int"))
    assert rows(table.read()) == rows(spark.createDataFrame(
        [("a", 7, "x"), ("a", 7, "x"), ("b", 8, None), (None, 9, "y")], "k string, n int, created_at string"))


@pytest.mark.parametrize("half", [False, True])
def test_a_driver_lost_after_the_change_is_written(spark, path, monkeypatch, half):
    table = KeyedTable(spark, path, ["k"], buckets=5)
    table.upsert(numbers(spark, 100))
    move = KeyedTable._move_in

    def lost(self, change):
        if half:  # some buckets of the table are gone already
            bucket = self._buckets_in(change)[0]
            fs, where = self._fs(f"{self.rows_path}/_bucket={bucket}")
            fs.delete(where, True)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(KeyedTable, "_move_in", lost)
    with pytest.raises(RuntimeError):
        table.upsert(numbers(spark, 3, "new"))
    monkeypatch.setattr(KeyedTable, "_move_in", move)
    want = [(k, "new" if k < 3 else "old") for k in range(100)]
    again = KeyedTable(spark, path)
    assert rows(again.read()) == want
    again.upsert(spark.createDataFrame([(99, "last")], "k long, v string"))
    assert rows(again.read()) == [*want[:-1], (99, "last")] and not again._changes()


def test_a_driver_lost_before_the_change_is_written(spark, path):
    table = KeyedTable(spark, path, ["k"], buckets=5)
    table.upsert(numbers(spark, 10))
    fs, where = table._fs(f"{path}/change-x/_bucket=1")
    fs.mkdirs(where)
    assert rows(table.read()) == [(k, "old") for k in range(10)]
    table.upsert(numbers(spark, 1, "new"))
    assert table.read().count() == 10 and not table._changes()


def test_empty_tables(spark, path):
    table = KeyedTable(spark, path, ["k"])
    assert not table.exists()
    table.upsert(numbers(spark, 0))
    assert table.exists() and rows(table.read()) == []
    table.upsert(numbers(spark, 0))
    table.upsert(numbers(spark, 2))
    assert rows(table.read()) == [(0, "old"), (1, "old")]


def test_update_of_one_label(spark, path):
    table = KeyedTable(spark, path, ["id"], buckets=8, by=["label"])
    table.create(spark.range(1000).select("id", (F.col("id") % 20).cast("string").alias("label"), F.lit(0).alias("n")))
    before = files(table)
    table.update(spark.createDataFrame([("7",)], "label string"), lambda r: r.withColumn("n", F.when(F.col("label") == "7", 1).otherwise(F.col("n"))))
    assert table.read().filter("n = 1").count() == 50 and table.read().count() == 1000
    assert len({os.path.dirname(f) for f in before ^ files(table)}) == 1


def test_a_change_is_moved_in_as_it_was_written(spark, path, monkeypatch):
    written, move = {}, KeyedTable._move_in

    def watched(self, change):
        written[change] = {f for _, _, names in os.walk(change) for f in names if f.endswith(".parquet")}
        move(self, change)

    monkeypatch.setattr(KeyedTable, "_move_in", watched)
    table = KeyedTable(spark, path, ["k"], buckets=5)
    table.upsert(numbers(spark, 100))
    old = {os.path.basename(f) for f in files(table)}
    table.upsert(numbers(spark, 1, "new"))
    first, second = written.values()
    assert old == first and {os.path.basename(f) for f in files(table)} > second  # the same files: no row is written again
    assert rows(table.read()) == [(k, "new" if k < 1 else "old") for k in range(100)] and not table._changes()


def test_a_driver_lost_while_buckets_are_moved_in(spark, path, monkeypatch):
    table = KeyedTable(spark, path, ["k"], buckets=5)
    table.upsert(numbers(spark, 100))
    listed = KeyedTable._buckets_in
    monkeypatch.setattr(KeyedTable, "_delete", lambda self, p: (_ for _ in ()).throw(RuntimeError("driver lost")))
    monkeypatch.setattr(KeyedTable, "_buckets_in", lambda self, p: listed(self, p)[:2] if "change-" in p else listed(self, p))
    with pytest.raises(RuntimeError):
        table.upsert(numbers(spark, 100, "new"))
    monkeypatch.undo()
    again = KeyedTable(spark, path)
    assert len(again._buckets_in(again._pending())) == 3
    assert rows(again.read()) == [(k, "new") for k in range(100)]
    again.recover()
    assert rows(again.read()) == [(k, "new") for k in range(100)] and not again._changes()
