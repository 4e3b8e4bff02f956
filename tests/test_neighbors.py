"""Exact neighbours: what is kept, and how much work is handed on."""

import glob

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tagloom.lineage import checkpoint_dir
from tagloom.operators import blocks


def rows_written(spark) -> int:
    folder = checkpoint_dir(spark).removeprefix("file:")
    return sum(pq.read_metadata(f).num_rows for f in glob.glob(f"{folder}/cut-*/*.parquet"))


def found(df):
    out = {}
    for r in df.orderBy("q_id", "rank").collect():
        out.setdefault(r["q_id"], []).append(r["t_id"])
    return out


def test_knn_over_many_blocks_hands_on_few_rows(spark):
    v = np.random.default_rng(5).normal(size=(1200, 24))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([("f", f"p{i}", [float(x) for x in r]) for i, r in enumerate(v)], "f string, id string, v array<double>")
    before = rows_written(spark)
    got = found(blocks.knn(df, ["f"], "id", "v", 3, block_rows=8))
    assert rows_written(spark) - before < 20 * len(v)
    sims = np.round(v @ v.T, 9)
    for i in (0, 7, 600, 1199):
        assert got[f"p{i}"] == sorted((f"p{j}" for j in range(len(v)) if j != i), key=lambda p: (-sims[i, int(p[1:])], p))[:3]


def test_knn_of_copies_takes_the_smallest_ids(spark):
    rows = [("f", f"c{i:03d}", [1.0, 0.0]) for i in range(40)] + [("f", "a", [0.6, 0.8]), ("f", "b", [0.0, 1.0]), ("f", None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "f string, id string, v array<double>")
    before = rows_written(spark)
    got = found(blocks.knn(df, ["f"], "id", "v", 3, block_rows=4))
    assert rows_written(spark) - before < 8 * len(rows)
    assert got["c000"] == ["c001", "c002", "c003"] and got["c002"] == ["c000", "c001", "c003"] and got["c030"] == ["c000", "c001", "c002"]
    assert got["b"] == ["a", "c000", "c001"] and got["a"] == ["b", "c000", "c001"] and None not in got


def test_points_meet_only_blocks_in_reach(spark, monkeypatch):
    monkeypatch.setattr(blocks, "POINT_ROWS", 16)
    rng = np.random.default_rng(3)
    p = np.round(rng.normal(size=(500, 2)) * 10, 1)
    p[:50] = p[100]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(p)] + [(None, [0.0, 0.0]), (900, None)], "id int, v array<double>")
    met = []
    whole = blocks._near_points
    monkeypatch.setattr(blocks, "_near_points", lambda on, k: met.append(k) or whole(on, k))
    got = found(blocks.nearest_points(df, "id", "v", 2))
    assert met and "900" not in got
    d = np.round(np.maximum((p * p).sum(1)[:, None] + (p * p).sum(1)[None, :] - 2 * (p @ p.T), 0.0), 9)
    origin = np.round((p * p).sum(1), 9)
    for i in range(len(p)):
        near = [(d[i, j] if (p[i] != p[j]).any() else 0.0, 1, str(j)) for j in range(len(p)) if j != i] + [(origin[i], 0, None)]
        assert got[str(i)] == [x[2] for x in sorted(near, key=lambda x: x[:2] if x[2] is None else x)[:2]], i


def test_knn_hands_a_row_to_few_pairs_of_tiles(spark, monkeypatch):
    p = np.random.default_rng(8).normal(size=(21_000, 4))
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    df = spark.createDataFrame([("f", f"p{i}", [float(x) for x in r]) for i, r in enumerate(p)], "f string, id string, v array<double>")
    sides = []
    whole = blocks.tile_sides
    monkeypatch.setattr(blocks, "tile_sides", lambda *a: sides.append(whole(*a)) or sides[-1])
    got = found(blocks.knn(df, ["f"], "id", "v", 3))
    handed = sum(side.agg(F.sum(F.size("ids"))).first()[0] for side in sides[0])
    assert len(p) < handed <= 6 * len(p)
    for i in (0, 7, 10_500, 20_999):
        sims = np.round(p @ p[i], 9)
        order = sorted((j for j in np.argsort(-sims)[:40] if j != i), key=lambda j: (-sims[j], f"p{j}"))
        assert got[f"p{i}"] == [f"p{j}" for j in order[:3]]
    for t in range(0, len(p), 1000):
        assert len(got[f"p{t}"]) == 3
