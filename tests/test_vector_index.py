"""The vector index against a scan of all rows, before and after new rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators.vector_index import VectorIndex


def clustered(n, groups, dim=16, spread=0.15, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    v = centres[np.arange(n) % groups] + rng.normal(size=(n, dim)) * spread / np.sqrt(dim)
    return v * rng.uniform(0.5, 3, (n, 1))


def table(spark, v, first=0):
    return spark.createDataFrame([(f"r{first + i:05d}", x.tolist(), i % 3) for i, x in enumerate(v)], "name string, v array<double>, kind int")


def scan(v, q):
    u, w = (x / np.linalg.norm(x, axis=1)[:, None] for x in (v, q))
    return np.round(w @ u.T, 9)


@pytest.fixture(scope="module")
def data():
    return clustered(3000, 30), clustered(25, 30, seed=1)[:25] + 0.01


@pytest.fixture(scope="module")
def index(spark, data, tmp_path_factory):
    v, _ = data
    made = VectorIndex.build(table(spark, v[:2500]), str(tmp_path_factory.mktemp("index") / "i"), "name", "v", cells=60)
    made.insert(table(spark, v[2500:], 2500), "name", "v")
    return made


def queries(spark, q):
    return spark.createDataFrame([(f"q{i}", x.tolist()) for i, x in enumerate(q)], "q string, x array<double>")


def test_top_k_equals_the_scan(spark, data, index):
    v, q = data
    got = index.search(queries(spark, q), "q", "x", k=7).select("q_id", "row.name", "sim", "rank").collect()
    sims = scan(v, q)
    for i in range(len(q)):
        order = sorted(range(len(v)), key=lambda j: (-sims[i, j], j))[:7]
        mine = sorted((r for r in got if r["q_id"] == f"q{i}"), key=lambda r: r["rank"])
        assert [r["sim"] for r in mine] == pytest.approx([sims[i, j] for j in order], abs=2e-9)
        assert {r["name"] for r in mine} == {f"r{j:05d}" for j in order}


def test_threshold_equals_the_scan(spark, data, index):
    v, q = data
    got = index.search(queries(spark, q), "q", "x", min_sim=0.9).select("q_id", "row.name").collect()
    sims = scan(v, q)
    assert {tuple(r) for r in got} == {(f"q{i}", f"r{j:05d}") for i, j in zip(*np.nonzero(sims >= 0.9))}


def test_few_cells_are_read(spark, data, index):
    _, q = data
    one = index._units(queries(spark, q[:1]), "q", "x").select(F.col("rid").alias("q_id"), F.col("v").alias("q"), F.lit(0.9).alias("needed"))
    cells = [r["cell"] for r in index.reachable(one).collect()]
    total = index.cells().count()
    assert 0 < len(cells) < total / 4  # the share of cells read on clustered data
    plan = index.rows(cells)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan or "PartitionFilters: [isnotnull(cell" in plan
    assert index.rows(cells).select("cell").distinct().count() == len(cells)


def test_odd_rows(spark, tmp_path):
    rows = [("a", [1.0, 0.0], 0), ("b", [2.0, 0.0], 0), ("c", None, 0), ("d", [0.0, 0.0], 0), ("e", [0.0, -1.0], 0)]
    index = VectorIndex.build(spark.createDataFrame(rows, "name string, v array<double>, kind int"), str(tmp_path / "i"), "name", "v")
    q = spark.createDataFrame([("x", [3.0, 0.0]), ("zero", [0.0, 0.0]), ("none", None)], "q string, v array<double>")
    got = index.search(q, "q", "v", k=5).select("q_id", "row.name", "sim", "rank").collect()
    assert sorted((r["q_id"], r["name"], r["sim"], r["rank"]) for r in got) == [("x", "a", 1.0, 1), ("x", "b", 1.0, 2), ("x", "e", 0.0, 3)]
    with pytest.raises(ValueError):
        index.search(q, "q", "v")
