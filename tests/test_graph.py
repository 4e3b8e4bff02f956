"""Communities of small graphs, found without a broadcast of a table that has a row per node."""

from tagloom.operators.graph import communities


def test_communities_broadcast_no_nodes(spark):
    rows = [(g, f"{c}{a}", f"{c}{b}", 1.0) for g in "gh" for c in "xy" for a in range(3) for b in range(a + 1, 3)]
    found = communities(spark.createDataFrame(rows, "graph string, src string, dst string, weight double"), graph="graph")
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()
    assert {(r["graph"], r["node"][0], r["community"]) for r in found.collect()} == {
        ("g", "x", 0), ("g", "y", 1), ("h", "x", 0), ("h", "y", 1)}


def test_a_round_shuffles_its_options_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tagloom.operators import graph as G

    rounds, whole = [], G.cut
    monkeypatch.setattr(G, "cut", lambda df: rounds.append(df) or whole(df))
    pairs = [("g", f"{s}{i}", f"{s}{j}", 0.9) for s in "ab" for i in range(4) for j in range(i + 1, 4)] + [("g", "a0", None, 0.5)]
    e = spark.createDataFrame(pairs, "graph string, src string, dst string, w double")
    both = whole(e.unionByName(e.select("graph", F.col("dst").alias("src"), F.col("src").alias("dst"), "w")))
    degree = both.groupBy("graph", F.col("src").alias("node")).agg(F.sum("w").alias("deg"))
    out = G._local_moving(both, degree, 1.0, both.groupBy("graph").agg(F.sum("w").alias("two_m")), 42).collect()
    plan = [df for df in rounds if "_wants" in df.columns][0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") <= 3 and plan.count("hashpartitioning(graph") + plan.count("hashpartitioning(coalesce(graph") <= 8, plan
    assert len(out) == 9 and len({r["comm"] for r in out if r["node"]}) == 2
    assert [r["comm"] for r in out if r["node"] is None] == [None]
