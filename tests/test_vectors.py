"""Vectors, neighbours and clusters against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tagloom.functions import vectors as V
from tagloom.operators import density as D
from tagloom.operators import graph as G
from tagloom.operators.blocks import knn
from tagloom.operators.centroids import centroids
from tagloom.sources import io


def frame(spark, v, field="f"):
    rows = [(field, f"p{i:03d}", [float(x) for x in r]) for i, r in enumerate(v)]
    return spark.createDataFrame(rows, "field_name string, label_id string, v array<double>")


def planted(n_groups=4, size=15, noise=12, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(n_groups, dim))
    points = [c + 0.05 * rng.normal(size=(size, dim)) for c in centers] + [rng.normal(size=(noise, dim))]
    v = np.vstack(points)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_parse_vector_modes(spark):
    rows = [("[3, 4]",), ("{3,4}",), ("[1, NaN]",), ("[]",), ("x",), (None,), ("[0,0]",)]
    df = spark.createDataFrame(rows, "t string")
    got = [tuple(r) for r in df.select(*[V.parse_vector(F.col("t"), m) for m in ("unit", "raw", "drop")]).collect()]
    assert got[0] == ([0.6, 0.8], [3.0, 4.0], [3.0, 4.0])
    assert got[1] == ([0.6, 0.8], [3.0, 4.0], None)
    assert got[2][:2] == (None, None)
    assert got[3] == (None, None, None) and got[5] == (None, None, None)
    assert got[6][0] == [0.0, 0.0]


def test_cosine_edge_cases(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0]), ([1.0], [1.0, 2.0]), ([1.0, 1.0], [1.0, 1.0])], "a array<double>, b array<double>")
    got = df.select(V.cosine(F.col("a"), F.col("b")), V.cosine(F.col("a"), F.col("b"), True)).collect()
    assert got[0][0] is None and got[0][1] == 0.0
    assert got[1][0] is None and got[1][1] is None
    assert abs(got[2][0] - 1) < 1e-12


def test_knn_over_many_blocks_equals_brute_force(spark):
    v = planted()
    got = knn(frame(spark, v), ["field_name"], "label_id", "v", 4, block_rows=8).collect()
    sims = np.round(v @ v.T, 9)
    want = {}
    for i in range(len(v)):
        order = sorted((j for j in range(len(v)) if j != i), key=lambda j: (-sims[i, j], f"p{j:03d}"))[:4]
        want[f"p{i:03d}"] = [f"p{j:03d}" for j in order]
    found = {}
    for r in sorted(got, key=lambda r: (r["q_id"], r["rank"])):
        found.setdefault(r["q_id"], []).append(r["t_id"])
    assert found == want


def test_spanning_tree_is_the_same_for_any_block_size(spark):
    v = planted(noise=20)
    weights = []
    for rows in (8, 512):
        tree = D.spanning_forest(frame(spark, v), 2, block_rows=rows).collect()
        assert len(tree) == len(v) - 1
        weights.append(sorted(round(r["w"], 6) for r in tree))
    assert weights[0] == weights[1]


def test_planted_groups_come_back_for_any_slice_size(spark):
    v = planted()
    df = frame(spark, v)
    edges = D.spanning_forest(df, 2).withColumn("mcs", F.lit(5))
    points = df.select("field_name", F.col("label_id").alias("rid"))
    results = []
    for size in (7, 100000):
        found = D.condense(points, edges, ["field_name"], size).collect()
        out = {r["rid"]: r["cluster_id"] for r in found}
        results.append(sorted((r["rid"], r["cluster_id"], round(r["probability"], 9)) for r in found))
        groups = [{out[f"p{i:03d}"] for i in range(g * 15, g * 15 + 15)} for g in range(4)]
        assert all(len(g) == 1 and -1 not in g for g in groups)
        assert len(set().union(*groups)) == 4
        # A stray point may hang on a group, but only loosely.
        assert all(r["probability"] < 0.5 for r in found if r["rid"] >= "p060")
    assert results[0] == results[1]


def test_components_and_communities_of_two_cliques(spark):
    pairs = [(f"{s}{i}", f"{s}{j}", 0.9) for s in "ab" for i in range(5) for j in range(i + 1, 5)]
    edges = spark.createDataFrame(pairs + [("a0", "b0", 0.1), ("x", "y", 0.9)], "src string, dst string, weight double")
    comp = {r["node"]: r["component"] for r in G.connected_components(edges).collect()}
    assert set(comp.values()) == {"a0", "x"}
    comm = {r["node"]: r["community"] for r in G.communities(edges).collect()}
    assert {comm[f"a{i}"] for i in range(5)} == {0} and {comm[f"b{i}"] for i in range(5)} == {1}
    assert comm["x"] == comm["y"] == -1


def test_centroids_do_not_depend_on_partitions(spark):
    v = planted()
    rows = [("f", "r", "v1", f"c{i % 3}", f"l{i}", 1 + i % 4, [float(x) for x in r]) for i, r in enumerate(v)]
    rows.append(("f", "r", "v1", "c0", "short", 9, [1.0]))
    rows.append(("f", "r", "v1", "c1", "none", 9, None))
    df = spark.createDataFrame(rows, "field_name string, run_id string, cluster_version string, cluster_id string, "
                                     "raw_label string, value_count int, embedding array<double>")
    got = [
        sorted((r["cluster_id"], r["medoid_label"], r["cluster_size"], [round(x, 9) for x in r["centroid"]])
               for r in centroids(df.repartition(n)).collect())
        for n in (1, 7)
    ]
    assert got[0] == got[1]
    mine = [i for i in range(len(v)) if i % 3 == 0]
    w = np.array([1 + i % 4 for i in mine])
    mean = (v[mine] * w[:, None]).sum(0) / w.sum()
    assert np.allclose(got[0][0][3], mean / np.linalg.norm(mean), atol=1e-8)


def test_dense_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"))
    got = io.dense_index(df, ["a"], "n").collect()
    assert all(r["a"] == r["n"] for r in got) and len(got) == 1000
