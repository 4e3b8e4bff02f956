"""State tables, windows and streams."""

import pytest
from pyspark.sql import functions as F

from tagloom.sources import io
from tagloom.sources.schemas import CLUSTERS, STATE_DEFAULTS, conform


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_is_idempotent_and_follows_rules(spark):
    t = spark.createDataFrame([("a", 5, "old"), ("b", 1, "old")], "k string, n int, s string")
    s = spark.createDataFrame([("a", 3, "new"), ("c", 9, "new")], "k string, n int, s string")
    rules = {"n": "greatest", "s": "keep"}
    once = io.upsert(t, s, ["k"], rules)
    assert rows(once) == [("a", 5, "old"), ("b", 1, "old"), ("c", 9, "new")]
    assert rows(io.upsert(once, s, ["k"], rules)) == rows(once)


def test_update_or_insert_updates_all_rows_of_a_key(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x")], "k string, n int, created_at string")
    s = spark.createDataFrame([("a", 7), ("b", 8)], "k string, n int")
    got = io.update_or_insert(t, s, ["k"])
    assert sorted(tuple(r) for r in got.fillna("-").collect()) == [("a", 7, "x"), ("a", 7, "x"), ("b", 8, "-")]


def test_window_rules():
    start, end = io.compute_window(None, "2024-01-02T00:00:00Z", io.timedelta(hours=1))
    assert (end - start).total_seconds() == 3600
    with pytest.raises(ValueError):
        io.compute_window("2024-01-03", "2024-01-02", io.timedelta(hours=1))
    io.compute_window("2024-01-03", "2024-01-02", io.timedelta(hours=1), reject_empty=False)


def test_id_ranges():
    assert io.id_ranges(1, 10, 3) == [(1, 4), (5, 8), (9, 10)]
    assert io.id_ranges(5, 5, 4) == [(5, 5)]


def test_conform_fills_and_renames(spark):
    df = spark.createDataFrame([("f", "c", [1.0])], "field_name string, cluster_id string, centroid array<double>")
    r = conform(df, CLUSTERS, STATE_DEFAULTS).first()
    assert r["centroid_embedding"] == [1.0] and r["active"] is True and r["cluster_version"] == "v1"
    assert r["medoid_label"] is None


def test_prepare_labels_rejects_missing_columns(spark):
    with pytest.raises(ValueError):
        io.prepare_labels(spark.createDataFrame([("a",)], "raw_value string"))


def test_history_headers(spark):
    df = spark.createDataFrame([("f", "A_b", "2.7"), ("f", "a b", "bad"), ("", "x", "1"), ("f", "c", "-1")],
                               ["\ufefffield", "unmapped_label", "occurrences"])
    assert rows(io.read_history_counts(df)) == [("f", "a b", 3)]


def test_export_writes_nested_columns_as_json(spark, tmp_path):
    df = spark.createDataFrame([("a", [1, 2])], "k string, v array<int>")
    io.export(df, str(tmp_path / "x"), "csv")
    assert spark.read.csv(str(tmp_path / "x"), header=True, escape='"').first()["v"] == "[1,2]"


def test_run_row(spark):
    r = io.run_row(spark, run_id="r", status="FAILED", rows=3, error="boom").first()
    assert (r["run_id"], r["status"], r["rows"], r["error"]) == ("r", "FAILED", 3, "boom")


def test_overlapping_windows(spark):
    from tagloom.streaming.mapper import status_windows

    df = spark.createDataFrame([("2024-01-01 00:30:00", "f", "S")], "t string, field_name string, mapping_status string")
    df = df.select(F.to_timestamp("t").alias("classified_at"), "field_name", "mapping_status")
    assert status_windows(df, "2 hours", "1 hour").count() == 2
