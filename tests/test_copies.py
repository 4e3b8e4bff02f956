"""Density clusters and silhouettes of many equal vectors."""

import glob

import numpy as np
from pyspark.sql import functions as F

from tagloom.lineage import checkpoint_dir
from tagloom.operators import density as D
from tagloom.operators import graph as G


def tables_written(spark) -> int:
    return len(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/cut-*"))


def test_copies_are_merged_at_once(spark):
    rows = [("f", f"p{g}{i:03d}", [1.0 if g == j else 0.0 for j in range(3)]) for g, n in enumerate((40, 30, 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "field_name string, label_id string, v array<double>")
    edges = D.spanning_forest(df, 2).withColumn("mcs", F.lit(5))
    assert edges.count() == len(rows) - 1
    before = tables_written(spark)
    found = D.condense(df.select("field_name", F.col("label_id").alias("rid")), edges, ["field_name"], slice_edges=4).collect()
    assert tables_written(spark) - before < 40
    assert {r["rid"][1]: r["cluster_id"] for r in found} == {"0": 0, "1": 1, "2": -1} and len(found) == len(rows)


def test_silhouette_hands_on_one_row_per_point_and_tile(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 5))
    own = rng.integers(0, 30, size=300)
    df = spark.createDataFrame([("f", f"p{i}", [float(x) for x in r], int(c)) for i, (r, c) in enumerate(zip(v, own))],
                               "f string, id string, v array<double>, c int")
    got = D.silhouette(df, ["f"], "id", "v", "c").first()
    d = np.sqrt(np.maximum(((v[:, None] - v[None]) ** 2).sum(-1), 0))
    s = []
    for i in range(300):
        means = {c: d[i, own == c].sum() / ((own == c).sum() - (c == own[i])) for c in set(own) if (own == c).sum() > (c == own[i])}
        a, b = means.pop(own[i], None), min(x for c, x in means.items() if c != own[i])
        s.append(0.0 if a is None else (b - a) / max(a, b))
    assert abs(got["silhouette"] - np.mean(s)) < 1e-6 and got["points"] == 300


def labelled(spark, n=400, clusters=12, seed=3):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 4))
    v[n // 2:] = v[rng.integers(0, 40, size=n - n // 2)]  # many copies
    own = rng.integers(-1, clusters, size=n)
    rows = [("fg"[i % 2], f"p{i}", [float(x) for x in r], int(c)) for i, (r, c) in enumerate(zip(v, own))]
    return spark.createDataFrame(rows, "f string, id string, v array<double>, c int")


def by_rows(df):
    rows = df.filter("c <> -1").select("f", F.col("id").alias("rid"), "v", "c")
    return {r["f"]: (round(r["silhouette"], 9), r["points"]) for r in D._silhouette_of_rows(rows, ["f"]).collect()}


def found(df):
    return {r["f"]: (round(r["silhouette"], 9), r["points"]) for r in D.silhouette(df, ["f"], "id", "v", "c").collect()}


def test_silhouette_takes_equal_vectors_once(spark, monkeypatch):
    packed, pack = [], D.pack
    monkeypatch.setattr(D, "pack", lambda df, *a, **b: packed.append(df.count()) or pack(df, *a, **b))
    df = labelled(spark)
    got = found(df)
    assert packed[0] < df.filter("c <> -1").count()  # copies in one cluster are one point
    assert got == by_rows(df)
    few = df.withColumn("c", F.when(F.col("c") >= 0, F.col("c") % 2).otherwise(-1))
    assert found(few) == by_rows(few)
    one = df.withColumn("c", F.lit(5))
    assert found(one) == by_rows(one) == {"f": (-1.0, 200), "g": (-1.0, 200)}
    twice = df.unionByName(df.limit(100))  # ids that repeat: every row takes part
    assert found(twice) == by_rows(twice)


def test_silhouettes_of_a_grid_share_their_distances(spark, monkeypatch):
    df, pack, tiles = labelled(spark), D.pack, D.tiles
    second = F.when(F.col("c") > 0, F.col("c") % 3).otherwise(F.lit(-1))
    rows = df.select("f", F.col("id").alias("rid"), "v", F.array("c", second, F.col("c"), F.lit(-1)).alias("own"))
    monkeypatch.setattr(D, "pack", lambda *a, **b: pack(*a, block_rows=16, **b))
    monkeypatch.setattr(D, "tiles", lambda blocks, key, **b: tiles(blocks, key, least=16, most=32, spread=30))
    got = {(r["f"], r["config"]): (round(r["silhouette"], 9), r["points"]) for r in D.silhouettes(rows, ["f"], [12, 3, 12, 1]).collect()}
    want, other = by_rows(df), by_rows(df.withColumn("c", second))
    assert got == {(f, j): w[f] for f in "fg" for j, w in enumerate((want, other, want))}


def test_tuning_searches_neighbours_once(spark, monkeypatch):
    searched, knn = [], D.knn
    monkeypatch.setattr(D, "knn", lambda df, on, row_id, vec, k, *a, **b: searched.append(k) or knn(df, on, row_id, vec, k, *a, **b))
    df = labelled(spark, 120).select(F.col("f").alias("field_name"), F.col("id").alias("label_id"), "v")
    _, scores = D.tune_density(df, [5, 8], [1, 2, 3])
    assert searched == [2]
    for ms in (2, 3):
        alone = D.density_cluster(df, 5, ms).filter("base_cluster_id = -1").groupBy("field_name").count()
        noise = {r["field_name"]: r["count"] for r in alone.collect()}
        assert {r["field_name"]: r["anomaly_count"] for r in scores.filter(f"config = '5/{ms}'").collect()} == {f: noise.get(f, 0) for f in "fg"}


def test_rounds_of_communities_broadcast_nothing(spark):
    pairs = [(f"{s}{i}", f"{s}{j}", 0.9) for s in "ab" for i in range(5) for j in range(i + 1, 5)]
    e = spark.createDataFrame(pairs, "src string, dst string, w double").withColumn("graph", F.lit("g"))
    both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w", "graph"))
    degree = both.groupBy("graph", F.col("src").alias("node")).agg(F.sum("w").alias("deg"))
    out = G._local_moving(both, degree, 1.0, both.groupBy("graph").agg(F.sum("w").alias("two_m")), 42)
    assert "two_m" in out.columns and len({r["comm"] for r in out.collect()}) == 2
