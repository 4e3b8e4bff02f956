"""The offline clustering run: labels to density clusters, recovered communities, registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import cut
from ..operators import centroids as C
from ..operators import density as D
from ..operators import graph as G


@dataclass(frozen=True)
class ClusterRun:
    mapping: DataFrame
    registry: DataFrame
    metrics: DataFrame
    report: DataFrame


def cluster_labels(labels: DataFrame, min_cluster_size: int = 5, min_samples: int = 2,
                   ks: tuple = (3, 5), thresholds: tuple = (0.90, 0.92, 0.94), tune: bool = False) -> ClusterRun:
    """``labels`` (field_name, label_id, raw_label, value_count, v); fields stay apart."""
    labels = cut(labels)
    if tune:
        base, _ = D.tune_density(labels, [5, 8, 12, 20, 30], [1, 2, 3, 5])
    else:
        base = D.density_cluster(labels, min_cluster_size, min_samples)
    values = cut(labels.withColumn("label_id", F.col("label_id").cast("string")).join(base, ["field_name", "label_id"]))
    noise = values.filter("base_cluster_id = -1").select(
        "field_name", F.col("label_id").alias("node"), "value_count", F.col("v").alias("embedding")
    )
    strict, metrics, edges = G.graph_sweep(noise, list(ks), list(thresholds))
    strict = strict.select("field_name", F.col("node").alias("label_id"), F.col("community").alias("strict_graph_community_id"))
    mapping = G.combined_mapping(values, strict)
    mapping = cut(G.graph_stats(mapping, edges.withColumn("mutual_knn", F.lit(True))))
    report = mapping.groupBy("field_name").agg(
        F.count("*").alias("total_labels"), F.sum("value_count").alias("total_occurrences"),
        *[F.count_if(F.col("final_cluster_source") == s).alias(f"{s}_labels")
          for s in ("base_hdbscan", "strict_graph_recovery", "true_anomaly")],
        F.countDistinct(F.when(~F.col("final_is_true_anomaly"), F.col("final_cluster_id"))).alias("final_cluster_count"),
    )
    return ClusterRun(mapping, C.registry(mapping), metrics, report)
