"""Graph recovery of noise labels: mutual neighbour edges, components, communities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import family_token
from ..lineage import cut
from ..sources.io import latest_per_key
from .blocks import knn


def mutual_knn_edges(
    neighbors: DataFrame, k: int, threshold: float, mutual: bool = True, on: tuple = ("field_name",)
) -> DataFrame:
    """One edge (src < dst, weight) per pair of neighbours at or above the threshold.

    ``mutual`` asks both rows to list each other among their first ``k``.
    """
    near = neighbors.filter((F.col("rank") <= k) & (F.col("sim") >= threshold))
    pairs = near.select(
        *on, F.least("q_id", "t_id").alias("src"), F.greatest("q_id", "t_id").alias("dst"), "sim"
    )
    edges = pairs.groupBy(*on, "src", "dst").agg(F.max("sim").alias("weight"), F.count("*").alias("_n"))
    return (edges.filter("_n = 2") if mutual else edges).drop("_n")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) with the least node of each component as its name.

    Alternating large-star and small-star steps, each two joins on the node, converge in
    about log(n) rounds; every round is checkpointed.
    """
    e = cut(
        edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u <> v").distinct()
    )
    nodes = cut(e.select(F.col("u").alias("node")).union(e.select("v")).distinct())

    def mark(df: DataFrame):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    before = mark(e)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        e = cut(small.filter("u <> v").distinct())
        now = mark(e)
        if now == before:
            break
        before = now
    found = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


#: Far beyond what any graph took; a loop that gets there is an error, never a result.
MAX_ROUNDS = 2000


def _local_moving(edges: DataFrame, degree: DataFrame, resolution: float, two_m: DataFrame, seed: int) -> DataFrame:
    """Assign each node to a neighbouring community until no node has a positive modularity gain.

    A share of the nodes may move per round (chosen by a hash of node and round): half at first, less
    from round to round, so that neighbours that would swap for ever come to move one by one.
    """
    # Rounds are many, so what a round sends through the driver counts: no table of a round is broadcast.
    # Options carry their community's total and their node's own columns, so a round shuffles by node once and joins twice.
    state = cut(degree.join(two_m.hint("merge"), "graph").select(*degree.columns, "two_m", F.col("node").alias("comm")))
    own_node = Window.partitionBy("graph", "node")
    links = edges.filter("src <> dst")
    for r in range(MAX_ROUNDS):
        totals = state.groupBy("graph", "comm").agg(F.sum("deg").alias("tot"))
        known = state.join(totals.hint("merge"), ["graph", "comm"], "left")
        other = known.select("graph", F.col("node").alias("dst"), "comm", "tot")
        into = links.join(other.hint("merge"), ["graph", "dst"]).select("graph", F.col("src").alias("node"), "comm", "tot", F.col("w").alias("into"))
        own = known.select("graph", "node", "comm", "tot", F.lit(0.0).alias("into"), "deg", "two_m", F.col("comm").alias("old"))
        options = into.unionByName(own, allowMissingColumns=True).repartition("graph", "node").groupBy("graph", "node", "comm").agg(
            F.sum("into").alias("into"), *[F.max(c).alias(c) for c in ("tot", "deg", "two_m", "old")])
        scored = (
            options.withColumns({c: F.max(c).over(own_node) for c in ("deg", "two_m", "old")})
            .withColumn("rest", F.col("tot") - F.when(F.col("comm") == F.col("old"), F.col("deg")).otherwise(0.0))
            .withColumn("gain", F.round(F.col("into") - resolution * F.col("deg") * F.col("rest") / F.col("two_m"), 9))
        )
        best = scored.groupBy("graph", "node").agg(
            F.min(F.struct((-F.col("gain")).alias("g"), "comm")).alias("b"),
            F.max(F.when(F.col("comm") == F.col("old"), F.col("gain"))).alias("stay"),
            *[F.max(c).alias(c) for c in ("deg", "two_m", "old")],
        )
        turn = F.pmod(F.xxhash64("node", F.lit(seed * 1000 + r)), F.lit(2 + r // 8)) == 0
        moved = best.withColumn("_wants", F.col("node").isNotNull() & F.coalesce(-F.col("b.g") > F.col("stay") + 1e-9, F.lit(False)))
        state = cut(moved.select(
            "graph", "node", "deg", "two_m", F.when(F.col("_wants") & turn, F.col("b.comm")).otherwise(F.col("old")).alias("comm"), "_wants"
        ))
        settled = state.filter("_wants").isEmpty()
        state = state.drop("_wants")
        if settled:
            return state
    raise RuntimeError(f"communities are not settled after {MAX_ROUNDS} rounds")


def communities(
    edges: DataFrame, resolution: float = 1.15, min_size: int = 3, seed: int = 42,
    graph: str | None = None,
) -> DataFrame:
    """Weighted Louvain communities: (graph, node, community), small groups are -1.

    Levels go on until no two communities merge; each has fewer nodes than the one before.

    Local moving and contraction are joins and aggregates over the edges of all graphs at
    once; a graph is a field, or a field and a configuration. Ids count from 0 per graph by
    size, then by least member.
    """
    g = F.col(graph) if graph else F.lit("g")
    base = edges.select(g.alias("graph"), F.col("src").cast("string").alias("src"),
                        F.col("dst").cast("string").alias("dst"), F.col("weight").cast("double").alias("w"))
    # Written ids take few bytes, so a table that Spark thinks small may have many rows: none with a row per node is broadcast.
    e = cut(base.unionByName(base.select("graph", F.col("dst").alias("src"), F.col("src").alias("dst"), "w")))
    two_m = cut(e.groupBy("graph").agg(F.sum("w").alias("two_m")))
    members = cut(e.select("graph", F.col("src").alias("node"), F.col("src").alias("comm")).distinct())
    while True:
        degree = e.groupBy("graph", F.col("src").alias("node")).agg(F.sum("w").alias("deg"))
        state = _local_moving(e, degree, resolution, two_m, seed)
        # Communities are named by their least node, so that names do not depend on moves.
        names = state.groupBy("graph", "comm").agg(F.min("node").alias("name"))
        label = cut(state.join(names.hint("merge"), ["graph", "comm"]).select("graph", "node", F.col("name").alias("to")))
        before = label.count()
        after = label.select("graph", "to").distinct().count()
        step = label.select("graph", F.col("node").alias("comm"), "to")
        members = cut(members.join(step.hint("merge"), ["graph", "comm"]).select("graph", "node", F.col("to").alias("comm")))
        if after == before:
            break
        a = label.select("graph", F.col("node").alias("src"), F.col("to").alias("s2"))
        b = label.select("graph", F.col("node").alias("dst"), F.col("to").alias("d2"))
        e = cut(
            e.join(a.hint("merge"), ["graph", "src"]).join(b.hint("merge"), ["graph", "dst"])
            .groupBy("graph", F.col("s2").alias("src"), F.col("d2").alias("dst")).agg(F.sum("w").alias("w"))
        )
    sizes = members.groupBy("graph", "comm").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    order = Window.partitionBy("graph").orderBy(F.col("n").desc(), F.col("first"))
    ids = sizes.filter(F.col("n") >= min_size).withColumn("community", F.row_number().over(order) - 1)
    out = members.join(ids.select("graph", "comm", "community").hint("merge"), ["graph", "comm"], "left").select(
        "graph", "node", F.coalesce("community", F.lit(-1)).alias("community")
    )
    return out if graph is None else out.withColumnRenamed("graph", graph)


def graph_metrics(labels: DataFrame, edges: DataFrame, comm: DataFrame, by: list[str],
                  resolution: float = 1.15) -> DataFrame:
    """Recovery numbers and score per graph.

    ``labels`` (by, node, value_count), ``edges`` (by, src, dst, weight), ``comm``
    (by, node, community). Modularity is computed in a column of its own and stays out of
    the score.
    """
    full = labels.join(comm.hint("merge"), [*by, "node"], "left").withColumn("community", F.coalesce("community", F.lit(-1)))
    grouped = F.col("community") != -1
    totals = full.groupBy(*by).agg(
        F.count("*").alias("total_labels"), F.sum("value_count").alias("total_occurrences"),
        F.count_if(grouped).alias("grouped_labels"),
        F.coalesce(F.sum(F.when(grouped, F.col("value_count"))), F.lit(0)).alias("grouped_occurrences"),
        F.countDistinct(F.when(grouped, F.col("community"))).alias("graph_communities_found"),
    )
    largest = full.filter(grouped).groupBy(*by, "community").count().groupBy(*by).agg(
        F.max("count").alias("largest_community_size")
    )
    n_edges = edges.groupBy(*by).agg(F.count("*").alias("edges"), (2 * F.sum("weight")).alias("_two_m"))
    side = [comm.select(*by, F.col("node").alias(e), F.col("community").alias(f"_{e}")) for e in ("src", "dst")]
    ends = edges.join(side[0].hint("merge"), [*by, "src"], "left").join(side[1].hint("merge"), [*by, "dst"], "left")
    inside = ends.filter("_src = _dst AND _src <> -1").groupBy(*by).agg((2 * F.sum("weight")).alias("_in"))
    deg = ends.select(*by, F.col("_src").alias("c"), "weight").unionByName(
        ends.select(*by, F.col("_dst").alias("c"), "weight")
    )
    spread = deg.filter("c <> -1").groupBy(*by, "c").agg(F.sum("weight").alias("d")).groupBy(*by).agg(
        F.sum(F.col("d") * F.col("d")).alias("_sq")
    )
    df = totals
    for part in (largest, n_edges, inside, spread):
        df = df.join(part, by, "left")
    zero = F.lit(0)
    n = F.col("total_labels")
    return df.withColumns({
        "largest_community_size": F.coalesce("largest_community_size", zero), "edges": F.coalesce("edges", zero),
    }).withColumns({
        "isolated_labels": n - F.col("grouped_labels"),
        "isolated_occurrences": F.col("total_occurrences") - F.col("grouped_occurrences"),
        "label_recovery_rate": F.col("grouped_labels") / n,
        "occurrence_recovery_rate": F.col("grouped_occurrences") / F.col("total_occurrences"),
        "isolated_ratio": (n - F.col("grouped_labels")) / n,
        "largest_community_ratio": F.col("largest_community_size") / n,
        "modularity": F.coalesce(
            F.col("_in") / F.col("_two_m") - resolution * F.col("_sq") / (F.col("_two_m") * F.col("_two_m")), F.lit(0.0)
        ),
    }).withColumn(
        "score", F.col("label_recovery_rate") - F.col("isolated_ratio") * 0.4 - F.col("largest_community_ratio") * 1.5
    ).drop("_two_m", "_in", "_sq")


def graph_sweep(
    labels: DataFrame, ks: list[int], thresholds: list[float], resolution: float = 1.15,
    min_size: int = 3, mutual: bool = True, seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Best communities of noise labels over all k and thresholds, with edges and metrics.

    ``labels`` (field_name, node, value_count, embedding). One neighbour search serves all
    configurations; their graphs are clustered together. Returns (labels with community,
    metrics per configuration, edges of the best configuration).
    """
    found = knn(labels, ["field_name"], "node", "embedding", max(ks), min_sim=min(thresholds))
    edges = None
    for k in ks:
        for t in thresholds:
            e = mutual_knn_edges(found, k, t, mutual).withColumns(
                {"k": F.lit(k), "threshold": F.lit(float(t)),
                 "graph": F.concat_ws("|", "field_name", F.lit(f"{k}|{t}"))}
            )
            edges = e if edges is None else edges.unionByName(e)
    edges = cut(edges)
    comm = communities(edges, resolution, min_size, seed, graph="graph")
    by = ["field_name", "k", "threshold", "graph"]
    configs = labels.sparkSession.createDataFrame(
        [(i, int(k), float(t)) for i, (k, t) in enumerate((k, t) for k in ks for t in thresholds)],
        "config int, k int, threshold double",
    )
    # The configuration table has len(ks) * len(thresholds) rows.
    each = labels.select("field_name", F.col("node").cast("string").alias("node"), "value_count").join(F.broadcast(configs)).withColumn(
        "graph", F.concat_ws("|", "field_name", F.concat_ws("|", F.col("k").cast("string"), F.col("threshold").cast("string")))
    )
    keyed = comm.join(each.select("graph", "field_name", "k", "threshold", "config").distinct(), "graph")
    metrics = cut(graph_metrics(
        each, edges, keyed.select(*by, "node", "community"), by, resolution
    ).join(configs.select("config", "k", "threshold"), ["k", "threshold"]))
    best = latest_per_key(metrics, ["field_name"], [F.round("score", 9).desc(), F.col("config")]).select(
        "field_name", "graph", F.col("k").alias("best_k"), F.col("threshold").alias("best_threshold")
    )
    chosen = comm.join(best, "graph").select("field_name", "node", "community", "best_k", "best_threshold")
    values = labels.withColumn("node", F.col("node").cast("string")).join(chosen.hint("merge"), ["field_name", "node"], "left").withColumn(
        "community", F.coalesce("community", F.lit(-1))
    )
    return values, metrics, edges.join(best.select("graph"), "graph").drop("graph")


def combined_mapping(base: DataFrame, strict: DataFrame) -> DataFrame:
    """Final cluster id and source: density cluster, recovered community, or anomaly.

    ``base`` (field_name, label_id, base_cluster_id ...), ``strict`` (field_name, label_id,
    strict_graph_community_id).
    """
    s = strict.select("field_name", "label_id", "strict_graph_community_id")
    recovered = F.coalesce(F.col("strict_graph_community_id") != -1, F.lit(False))
    grouped = F.col("base_cluster_id") != -1
    source = (
        F.when(recovered, "strict_graph_recovery").when(grouped, "base_hdbscan").otherwise("true_anomaly")
    )
    return base.join(s, ["field_name", "label_id"], "left").withColumns({
        "final_cluster_source": source,
        "final_cluster_id": F.when(recovered, F.concat(F.lit("strict_"), F.col("strict_graph_community_id").cast("string")))
        .when(grouped, F.concat(F.lit("base_"), F.col("base_cluster_id").cast("string"))).otherwise("anomaly"),
        "final_is_true_anomaly": source == "true_anomaly",
    })


def graph_stats(mapping: DataFrame, edges: DataFrame) -> DataFrame:
    """Highest cosine and mutual flag from both edge ends, for recovered labels only."""
    ends = [
        edges.select("field_name", F.col(c).alias("label_id"), "weight", "mutual_knn") for c in ("src", "dst")
    ]
    per = ends[0].unionByName(ends[1]).groupBy("field_name", "label_id").agg(
        F.max("weight").alias("_w"), F.max("mutual_knn").alias("_m")
    )
    recovered = F.col("final_cluster_source") == "strict_graph_recovery"
    return mapping.join(per, ["field_name", "label_id"], "left").withColumns({
        "graph_max_cosine_sim": F.when(recovered, F.col("_w")),
        "graph_mutual_knn": F.when(recovered, F.coalesce("_m", F.lit(False))).otherwise(F.lit(False)),
    }).drop("_w", "_m")


def first_labels(df: DataFrame, keys: list[str], n: int, order: list, out: str = "sample_labels") -> DataFrame:
    """First ``n`` raw labels per key, joined; ranked before they are collected."""
    w = Window.partitionBy(*keys).orderBy(*order)
    top = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return top.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("_rn", "raw_label"))).getField("raw_label"), " | ").alias(out)
    )


def summarize_clusters(df: DataFrame, cluster: str, n: int = 25) -> DataFrame:
    """Label count, occurrences, fields and first labels (by label id) per cluster."""
    stats = df.groupBy(cluster).agg(
        F.count("*").alias("label_count"), F.sum("value_count").alias("total_occurrences"),
        F.array_join(F.array_sort(F.collect_set("field_name")), " | ").alias("source_columns"),
    )
    return stats.join(first_labels(df, [cluster], n, [F.col("label_id")]), cluster).withColumn(
        "is_noise", F.col(cluster) == -1
    ).orderBy("is_noise", F.col("label_count").desc(), F.col("total_occurrences").desc(), cluster)


def family_tests(df: DataFrame, community: str = "community") -> DataFrame:
    """Per first token with three labels or more: how its labels spread over communities."""
    f = df.withColumn("family_token", family_token(F.col("raw_label"))).filter("family_token IS NOT NULL")
    stats = f.groupBy("family_token").agg(
        F.count("*").alias("label_count"), F.sum("value_count").alias("total_occurrences"),
        F.countDistinct(community).alias("community_count"), F.count_if(F.col(community) != -1).alias("grouped_count"),
        F.count_if(F.col(community) == -1).alias("isolated_count"),
    ).filter("label_count >= 3").withColumn("isolated_ratio", F.col("isolated_count") / F.col("label_count"))
    w = Window.partitionBy("family_token").orderBy(community)
    seen = (
        f.select("family_token", community).distinct().withColumn("_rn", F.row_number().over(w)).filter("_rn <= 20")
        .groupBy("family_token")
        .agg(F.array_join(F.array_sort(F.collect_list(community)).cast("array<string>"), ", ").alias("communities_seen"))
    )
    samples = first_labels(f, ["family_token"], 25, [F.col("label_id")])
    return stats.join(seen, "family_token").join(samples, "family_token")


def weighted_sample(df: DataFrame, n: int, row_id: str, weight: str = "value_count", seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, chance by weight; all rows when there are few.

    Each row gets the key -log(u) / w with u from a hash of its id; the least keys win, so
    the sample does not depend on partitioning.
    """
    digest = F.md5(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(str(seed))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    w = F.greatest(F.lit(1.0), F.coalesce(F.col(weight).cast("double"), F.lit(1.0)))
    return df.withColumn("_key", -F.log(u) / w).orderBy("_key", row_id).limit(n).drop("_key")
