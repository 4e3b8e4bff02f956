"""Labels of calls: dealt out before they are parsed, the earliest of a record kept; the stream maps no empty batch."""

from datetime import datetime

from pyspark.sql import functions as F

from tagloom import skew
from tagloom.functions.keys import row_hashes
from tagloom.operators.labels import explode_calls
from tagloom.plans.mapping import MapperConfig
from tagloom.sources.keyed import KeyedTable
from tagloom.streaming import mapper

CALLS = "call_id string, created_at timestamp, tags string, outcome string"


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_calls_of_one_part_are_parsed_in_many(spark):
    rows = [(f"c{i}", datetime(2024, 1, 1), "a|b", "x") for i in range(200)]
    calls = spark.createDataFrame(rows, CALLS).coalesce(1)
    for unique in (True, False):
        found = explode_calls(calls, ["tags", "outcome"], "db", "t", "call_id", unique_ids=unique)
        assert found.count() == 600
        assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
        assert exchanges(found) == 1  # labels of a record stay where its rows were dealt to


def test_earliest_of_a_record_stays(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [
        ("c1", late, "A_b|c", None), ("c1", early, "x|a b", None), ("c1", late, "x|a b", None), ("c1", early, "x|a b", None),
        ("c2", None, "A_b", "o"), ("c2", late, "a b", "o"), (None, late, "z", "o"), (None, late, "z", "o"), (None, early, "z", "o"),
    ]
    found = explode_calls(spark.createDataFrame(rows, CALLS), ["tags", "outcome"], "db", "t", "call_id").collect()
    named = sorted((r["source_record_id"], r["field_name"], r["normalized_label"], r["raw_label"], str(r["source_created_at"])[:10])
                   for r in found if r["source_record_id"] in ("c1", "c2"))
    assert named == [
        ("c1", "tags", "a b", "a b", "2024-01-01"), ("c1", "tags", "c", "c", "2024-01-02"), ("c1", "tags", "x", "x", "2024-01-01"),
        ("c2", "outcome", "o", "o", "None"), ("c2", "tags", "a b", "A_b", "None")]
    assert len(found) == len(named) + 4  # rows without an id are records by what they say


def test_stream_maps_no_empty_batch(spark, tmp_path, monkeypatch):
    rows = [(f"c{i % 20}", datetime(2024, 1, 1, i % 20), "a|b", "x") for i in range(40)]
    spark.createDataFrame(rows, CALLS).coalesce(1).write.parquet(f"{tmp_path}/in")
    mapped = []

    def map_labels(labels, taxonomy, provider, config):
        mapped.append(labels.count())
        return labels.withColumn("cluster_version", F.lit("v1"))

    monkeypatch.setattr(mapper, "map_labels", map_labels)
    calls = spark.readStream.schema(CALLS).parquet(f"{tmp_path}/in")
    config = MapperConfig(fields=["tags", "outcome"], created="created_at")
    mapper.map_stream(calls, None, f"{tmp_path}/out", config, watermark="1 hour").awaitTermination()
    assert mapped == [3]
    assert KeyedTable(spark, f"{tmp_path}/out").read().select("source_record_id", "field_name", "raw_label").distinct().count() == 60
    assert KeyedTable(spark, f"{tmp_path}/out").read().count() == 60


def test_rows_of_the_stream_get_their_vectors_where_their_bucket_lies(spark, tmp_path, monkeypatch):
    rows = [(f"c{i % 150}", datetime(2024, 1, 1, i % 20), f"a|b{i % 150}", "x") for i in range(300)]
    spark.createDataFrame(rows, CALLS).coalesce(1).write.parquet(f"{tmp_path}/in")
    got = {}

    def map_labels(labels, taxonomy, provider, config):
        wide = F.array(*[F.xxhash64("normalized_label", F.lit(i)).cast("double") for i in range(8)])
        return labels.withColumns({"cluster_version": F.lit("v1"), "label_embedding": wide})

    def upsert(self, source, dealt=False):
        lies = source.select(self.bucket().alias("b"), F.spark_partition_id().alias("p")).distinct().groupBy("b").count()
        got.update(dealt=dealt, parts=lies.agg(F.max("count")).first()[0], plan=source._jdf.queryExecution().executedPlan().toString())
        whole(self, source, dealt=dealt)

    whole = KeyedTable.upsert
    monkeypatch.setattr(KeyedTable, "upsert", upsert)
    monkeypatch.setattr(mapper, "map_labels", map_labels)
    monkeypatch.setattr(skew, "LEAST_HOT", 100)  # a and x are common, the others are not
    calls = spark.readStream.schema(CALLS).parquet(f"{tmp_path}/in")
    config = MapperConfig(fields=["tags", "outcome"], created="created_at", unique_ids=True)
    mapper.map_stream(calls, None, f"{tmp_path}/out", config, watermark="1 hour").awaitTermination()
    assert got["dealt"] and got["parts"] <= 2  # common labels where they lie, others as they are dealt out again
    out = KeyedTable(spark, f"{tmp_path}/out").read()
    assert out.count() == out.select("dedupe_key").distinct().count() == 450
    assert out.filter("label_embedding IS NULL").isEmpty() and out.select("normalized_label").distinct().count() == 152


def test_row_hashes_see_nulls_and_lengths(spark):
    kinds = "a string, b string, v array<double>, w array<double>, c array<struct<x: string, y: string>>"
    data = [
        ("p", None, [1.0], [2.0], [("q", None)]), (None, "p", [1.0], [2.0], [("q", None)]), ("p", None, [1.0], [2.0], [(None, "q")]),
        ("p", None, [1.0, 2.0], [], [("q", None)]), ("p", None, [1.0], None, [("q", None)]), ("p", None, [1.0], [2.0], [None, ("q", None)]),
        ("p", None, [1.0, None], [2.0], [("q", None)]), ("p", None, [None, 1.0], [2.0], [("q", None)]), ("p", None, [1.0], [2.0], [("q", None)]),
    ]
    df = spark.createDataFrame(data, kinds)
    found = [tuple(r) for r in row_hashes(df, "a").collect()]
    assert found[0] == found[-1] and len(set(found)) == len(data) - 1
    assert all(h1 != h2 for h1, h2 in found)
    assert [tuple(r) for r in row_hashes(df.select(*reversed(df.columns)), "a").collect()] == found
