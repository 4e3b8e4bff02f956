"""Options beside the exact forms: approximate neighbours, sketches, pages by key, centroids by differences."""

import numpy as np
from pyspark.sql import functions as F

from tagloom.operators import centroids as C
from tagloom.operators.blocks import knn
from tagloom.operators.centroid_sums import CentroidSums
from tagloom.operators.near_knn import approximate_knn
from tagloom.operators.sketches import approximate_counts, hourly_sketches
from tagloom.sources.pages import cursor, page


def test_recall_of_approximate_neighbours(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24))
    v = centres[np.arange(2400) % 40] + rng.normal(size=(2400, 24)) * 0.5
    v /= np.linalg.norm(v, axis=1)[:, None]
    df = spark.createDataFrame([(f"f{i % 2}", f"r{i:04d}", x.tolist()) for i, x in enumerate(v)], "f string, id string, v array<double>")
    want = {(r["q_id"], r["t_id"]) for r in knn(df, ["f"], "id", "v", 5).collect()}
    found = approximate_knn(df, ["f"], "id", "v", 5, bucket_rows=100).collect()
    got = {(r["q_id"], r["t_id"]) for r in found}
    assert len(got) == len(found) and max(r["rank"] for r in found) == 5
    assert len(want & got) >= 0.9 * len(want)  # recall against the exact search
    again = {(r["q_id"], r["t_id"]) for r in approximate_knn(df.repartition(3), ["f"], "id", "v", 5, bucket_rows=100).collect()}
    assert again == got
    assert approximate_knn(df.limit(0), ["f"], "id", "v", 5).count() == 0


def test_sketches_are_within_their_bound(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 50 > 0, F.concat(F.lit("c"), (F.col("id") % 21_001).cast("string"))).alias("source_record_id"),
        F.timestamp_seconds(1_704_067_200 + (F.col("id") % 72) * 1800).alias("classified_at"), (F.col("id") % 2).cast("string").alias("field_name"))
    kept = hourly_sketches(rows, ["field_name"]).cache()
    for start, end in ((None, None), ("2024-01-01T06:00:00Z", "2024-01-01T20:00:00Z")):
        part = rows if start is None else rows.filter("classified_at >= '2024-01-01 06:00:00' AND classified_at < '2024-01-01 20:00:00'")
        want = {r[0]: (r[1], r[2]) for r in part.groupBy("field_name").agg(F.count("*"), F.countDistinct("source_record_id")).collect()}
        got = {r["field_name"]: (r["n_rows"], r["distinct_calls"]) for r in approximate_counts(kept, ["field_name"], start, end).collect()}
        assert want.keys() == got.keys()
        for k, (n, calls) in want.items():
            assert got[k][0] == n and abs(got[k][1] - calls) <= 5 * 1.04 / 64 * calls


def test_pages_put_together_are_the_whole(spark, tmp_path):
    spark.range(100).select((F.col("id") % 7).alias("a"), F.col("id").alias("b")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    order = [("a", True), ("b", False)]
    seen, last = [], None
    while rows := page(df, order, 9, last).collect():
        seen += [tuple(r) for r in rows]
        last = cursor(rows, order)
    assert seen == sorted(((i % 7, i) for i in range(100)), key=lambda r: (-r[0], r[1]))
    assert cursor([], order) is None
    plan = page(df, order, 9, {"a": 3, "b": 10})._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(LessThan(a,3),And(EqualTo(a,3),GreaterThan(b,10)))]" in plan


def members(spark, rows):
    return spark.createDataFrame(rows, "cluster_id string, raw_label string, value_count int, embedding array<double>")


def test_centroids_by_differences(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(f"c{i % 4}", f"l{i:03d}", int(rng.integers(0, 5)), rng.normal(size=8).tolist()) for i in range(200)]
    rows += [("c0", "none", 3, None), ("c9", "only", 1, [1.0] + [0.0] * 7)]
    kept = CentroidSums(spark, str(tmp_path / "s"), ["cluster_id"], buckets=4)

    def check(now):
        want = {r["cluster_id"]: (r["centroid"], r["medoid_label"]) for r in C.centroids(members(spark, now), "backfill", ["cluster_id"]).collect()}
        got = {r["cluster_id"]: r["centroid"] for r in kept.centroids().collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert np.allclose(got[k], want[k][0], atol=1e-9)
        return want

    kept.change(members(spark, rows[:120]))
    check(rows[:120])
    kept.choose(members(spark, rows[:120]))
    moved = [(("c1" if c == "c0" else c), label, n, v) for c, label, n, v in rows[:30]]
    now = moved + rows[60:]  # the first thirty are moved, thirty go, the others come
    kept.change(members(spark, moved + rows[120:]), members(spark, rows[:60]))
    want = check(now)
    before = {r["cluster_id"]: r["medoid_label"] for r in kept.medoids.read().collect()}
    stale = {r["cluster_id"] for r in kept.stale(1e-12, members(spark, rows[:60])).collect()}
    assert stale == set(want)
    kept.choose(members(spark, now), 1e-12)
    assert {r["cluster_id"]: r["medoid_label"] for r in kept.medoids.read().collect()} == {k: m for k, (_, m) in want.items()}
    assert kept.stale(0.01).count() == 0 and before.keys() <= want.keys()
    kept.change(members(spark, rows[:0]), members(spark, [rows[-1]]))  # the last member of a cluster goes
    assert {r["cluster_id"] for r in kept.centroids().collect()} == {"c0", "c1", "c2", "c3"}
