"""Members, centroids, medoids and representative labels of clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.text import strip, valid_label
from ..lineage import cut
from .vector_mean import mean_vectors

KEY = ["field_name", "run_id", "cluster_version", "cluster_id"]


def centroid_members(
    clusters: DataFrame, label_map: DataFrame, embeddings: DataFrame, by: str = "raw"
) -> DataFrame:
    """Label rows of each cluster with their vectors (null when there is none).

    ``raw``         inner on field, run, version and cluster, vectors by lower-case raw
                    label; anomaly labels are left out (rebuild)
    ``normalized``  inner on field, cluster and version (null is v1), vectors by
                    normalized label (weekly, backfill)
    """
    m = label_map.withColumnRenamed("final_cluster_id", "cluster_id")
    if by == "raw":
        m = m.filter(~F.coalesce("final_is_true_anomaly", F.lit(False)))
        m = m.filter(valid_label(F.col("raw_label")))
        joined = clusters.select(*KEY).join(m, KEY)
        key = F.lower(strip(F.col("raw_label")))
        e = embeddings.select("field_name", key.alias("_k"), F.col("embedding"))
        joined = joined.withColumn("_k", key)
        joined = joined.join(e, ["field_name", "_k"], "left").drop("_k")
    else:
        v1 = F.coalesce("cluster_version", F.lit("v1"))
        c = clusters.select("field_name", "run_id", "cluster_id", v1.alias("cluster_version"))
        m = m.drop("run_id").withColumn("cluster_version", v1)
        joined = c.join(m, ["field_name", "cluster_id", "cluster_version"]).join(
            embeddings.select("field_name", "normalized_label", "embedding"),
            ["field_name", "normalized_label"],
        )
    return joined.select(
        *KEY, "raw_label", "normalized_label",
        F.coalesce("value_count", F.lit(1)).alias("value_count"), "embedding",
    )


def centroids(members: DataFrame, mode: str = "rebuild", keys: list[str] = KEY) -> DataFrame:
    """One row per cluster that has a usable vector.

    ``rebuild``   weights max(count, 1); the most frequent dimension (ties: smaller); raw
                  vectors averaged; 12 representatives by count, similarity, label
    ``backfill``  weights max(count, 1); unit vectors; dimension of the first label; 12
                  representatives by summed count
    ``weekly``    no weights; unit vectors; 10 representatives by summed count

    Means, medoids and counters aggregate map-side; the top representatives use a rank
    filter, which Spark applies before the shuffle. No cluster is gathered in one task.
    """
    limit = 10 if mode == "weekly" else 12
    vec = V.parse_vector(F.col("embedding"), "raw" if mode == "rebuild" else "unit", is_array=True)
    rows = members.withColumn("_v", vec).withColumn("_dim", F.size("_v"))
    weight_of = F.greatest(F.coalesce("value_count", F.lit(1)), F.lit(1)).cast("bigint").alias("_w")
    usable = rows.filter(F.col("_v").isNotNull()).select(*keys, "raw_label", "_v", "_dim", weight_of)
    usable = cut(usable)  # read by four aggregates below
    if mode == "rebuild":
        per_dim = usable.groupBy(*keys, "_dim").agg(F.count("*").alias("_c"))
        dims = per_dim.groupBy(*keys).agg(
            F.min(F.struct((-F.col("_c")).alias("c"), "_dim")).getField("_dim").alias("_dim")
        )
    else:
        dims = usable.groupBy(*keys).agg(F.min_by("_dim", "raw_label").alias("_dim"))
    same = usable.join(dims, [*keys, "_dim"])
    weight = None if mode == "weekly" else "_w"
    means = mean_vectors(same, keys, "_v", weight).select(
        *keys, V.l2_normalize(F.col("mean")).alias("centroid")
    )
    scored = same.join(means, keys).withColumn(
        "_sim", F.round(V.cosine(F.col("_v"), F.col("centroid"), zero_norm_as_one=True), 9)
    )
    stats = scored.groupBy(*keys).agg(
        F.first("centroid").alias("centroid"),
        F.min(F.struct((-F.col("_sim")).alias("s"), "raw_label", "_w")).alias("_m"),
        F.count("*").alias("usable_rows"),
        F.countDistinct("raw_label").alias("cluster_size"),
        F.sum("_w").alias("total_occurrences"),
    )
    per_label = scored
    if mode != "rebuild":
        per_label = scored.groupBy(*keys, "raw_label").agg(
            F.sum("_w").alias("_w"), F.max("_sim").alias("_sim")
        )
        order = [F.col("_w").desc(), F.col("raw_label")]
    else:
        order = [F.col("_w").desc(), F.col("_sim").desc(), F.col("raw_label")]
    top = per_label.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    reps = (
        top.filter(F.col("_rn") <= limit)
        .groupBy(*keys)
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("_rn", "raw_label", F.col("_w").alias("value_count"),
                             F.col("_sim").alias("similarity"))
                )
            ).alias("representatives")
        )
    )
    return stats.join(reps, keys).select(
        *keys, "centroid", F.size("centroid").alias("dim"),
        F.col("_m.raw_label").alias("medoid_label"),
        (-F.col("_m.s")).alias("medoid_similarity"),
        F.col("_m._w").alias("medoid_count"),
        "usable_rows", "cluster_size", "total_occurrences", "representatives",
    )


def rebuild_centroids(
    clusters: DataFrame, label_map: DataFrame, embeddings: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """New centroids of the active standard clusters, and the clusters that have an issue.

    Nothing may be written while the second table has rows; see :func:`apply_rebuild`.
    """
    target = clusters.filter(
        F.coalesce("active", F.lit(True)) & ~F.coalesce("is_true_anomaly_cluster", F.lit(False))
    ).select(*KEY, F.col("cluster_size").alias("size_before"), F.col("total_occurrences").alias("occurrences_before"))
    members = centroid_members(target, label_map, embeddings)
    counts = members.groupBy(*KEY).agg(
        F.count("*").alias("label_rows"),
        F.count_if(F.col("embedding").isNull()).alias("missing_embedding_rows"),
    )
    new = centroids(members)
    matched = [F.col(f"t.{k}").eqNullSafe(F.col(f"n.{k}")) for k in KEY]
    both = target.alias("t").join(new.alias("n"), matched, "left")
    with_counts = both.join(
        counts.alias("c"), [F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in KEY], "left"
    )
    own = [F.col(f"t.{c}") for c in target.columns]
    numbers = [
        F.coalesce(F.col(f"c.{c}"), F.lit(0)).alias(c) for c in ("label_rows", "missing_embedding_rows")
    ]
    review = with_counts.filter(F.col("n.centroid").isNotNull()).select(
        *own, *numbers, *[F.col(f"n.{c}") for c in new.columns if c not in KEY]
    )
    issues = with_counts.filter(F.col("n.centroid").isNull()).select(
        *[F.col(f"t.{k}") for k in KEY], F.lit("no_usable_embeddings").alias("issue"), *numbers
    )
    return review, issues


def apply_rebuild(clusters: DataFrame, review: DataFrame, issues: DataFrame) -> DataFrame:
    """Clusters with the rebuilt values; refuses while there are issues."""
    if not issues.isEmpty():
        raise ValueError("some clusters have no usable embeddings; nothing is written")
    new = review.select(
        *KEY, F.col("centroid").alias("_c"), F.col("medoid_label").alias("_m"),
        F.col("medoid_similarity").alias("_s"),
    )
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in KEY]
    joined = clusters.alias("o").join(new.alias("n"), same, "left")
    replace = {"centroid_embedding": "_c", "medoid_label": "_m", "medoid_similarity_to_centroid": "_s"}
    return joined.select(
        *[
            (F.coalesce(F.col(f"n.{replace[c]}"), F.col(f"o.{c}")) if c in replace else F.col(f"o.{c}")).alias(c)
            for c in clusters.columns
        ]
    )


def rebuild_missing_centroids(clusters: DataFrame, label_map: DataFrame, embeddings: DataFrame,
                              fields: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(clusters, rebuilt keys): active standard clusters without a centroid get one, with medoid and counts.

    Mean of the unit vectors of the cluster's labels, as the weekly job takes it; clusters without a usable vector stay
    as they are. ``fields`` (field_name) limits the repair.
    """
    wanted = clusters.filter(
        F.coalesce("active", F.lit(True)) & ~F.coalesce("is_true_anomaly_cluster", F.lit(False))
        & F.col("centroid_embedding").isNull())
    if fields is not None:
        wanted = wanted.join(fields.select("field_name").distinct(), "field_name", "left_semi")
    new = cut(centroids(centroid_members(wanted, label_map, embeddings, by="normalized"), "weekly"))
    values = new.select(
        *[F.col(k).alias(f"_{k}") for k in KEY], F.col("centroid").alias("_centroid_embedding"),
        F.col("medoid_label").alias("_medoid_label"), F.col("medoid_similarity").alias("_medoid_similarity_to_centroid"),
        F.col("representatives.raw_label").alias("_representative_labels"), F.col("cluster_size").alias("_cluster_size"),
        F.col("total_occurrences").alias("_total_occurrences"), F.lit(True).alias("_hit"))
    same = [
        (F.coalesce(clusters[k], F.lit("v1")) if k == "cluster_version" else clusters[k]).eqNullSafe(F.col(f"_{k}")) for k in KEY
    ]
    both = clusters.join(values, [*same, clusters["centroid_embedding"].isNull()], "left")
    own = [c.removeprefix("_") for c in values.columns if c not in ("_hit", *(f"_{k}" for k in KEY))]
    out = both.select(*[
        F.when(F.col("_hit"), F.col(f"_{c}").cast(clusters.schema[c].dataType)).otherwise(clusters[c]).alias(c) if c in own else clusters[c]
        for c in clusters.columns
    ])
    return out, new.select(*KEY)


def registry(mapping: DataFrame, vec: str = "v") -> DataFrame:
    """One row per final cluster without anomalies: counts, sources, unit mean of the label
    vectors (not weighted) and the most frequent label as medoid."""
    keys = ["field_name", "final_cluster_id"]
    m = mapping.filter(~F.coalesce("final_is_true_anomaly", F.lit(False)))
    label = strip(F.col("raw_label"))
    stats = m.groupBy(*keys).agg(
        F.countDistinct("raw_label").alias("label_count"), F.sum("value_count").alias("total_occurrences"),
        F.array_join(F.array_sort(F.collect_set("final_cluster_source")), " | ").alias("final_cluster_source"),
    )
    counts = m.filter(label != "").groupBy(*keys, label.alias("_label")).agg(F.sum("value_count").alias("_c"))
    medoid = counts.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_c")).alias("c"), "_label")).getField("_label").alias("medoid_label")
    )
    means = mean_vectors(m.filter(F.col(vec).isNotNull()), keys, vec).select(
        *keys, V.l2_normalize(F.col("mean")).alias("centroid_embedding")
    )
    return stats.join(medoid, keys, "left").join(means, keys, "left").withColumn(
        "is_true_anomaly_cluster", F.lit(False)
    )
