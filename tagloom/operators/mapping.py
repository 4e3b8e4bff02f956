"""Assignment of labels to clusters: exact keys first, then centroid similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import guards
from ..functions import vectors as V
from ..functions.lists import (
    ANOMALY_THRESHOLD, CANDIDATE, CANDIDATE_THRESHOLD, EXISTING, EXISTING_THRESHOLD,
    KNOWN_ANOMALY, NO_REFERENCE, SEMANTIC_MARGIN, TRUE_ANOMALY,
)
from ..functions.text import normalize_label, pin
from ..lineage import cut
from ..sources.io import latest_per_key
from .blocks import best_targets


def is_active() -> Column:
    return F.coalesce(F.col("active"), F.lit(True))


def is_anomaly() -> Column:
    return F.coalesce(F.col("is_true_anomaly_cluster"), F.lit(False))


def version_or_v1(c: str | Column = "cluster_version") -> Column:
    return F.coalesce(c, F.lit("v1"))


def active_clusters(
    clusters: DataFrame,
    fields: list[str] | None = None,
    anomaly: bool | None = None,
    version: str | None = None,
    with_centroid: bool = True,
) -> DataFrame:
    df = clusters.filter(is_active())
    if fields is not None:
        df = df.filter(F.col("field_name").isin(fields))
    if anomaly is not None:
        df = df.filter(is_anomaly() == F.lit(anomaly))
    if version is not None:
        df = df.filter(version_or_v1() == version)
    return df.filter(F.col("centroid_embedding").isNotNull()) if with_centroid else df


def with_names(
    clusters: DataFrame, names: DataFrame, mode: str = "tolerant", keep_all: bool = False
) -> DataFrame:
    """Attach ``name`` and ``naming_method`` from the names table.

    ``tolerant``  run and version match or are null on either side
    ``strict``    run and version are equal

    Several names may fit; the best is kept (exact version, exact run, newest, name) unless
    ``keep_all`` asks for the fan-out.
    """
    n = names.select(
        "field_name", "cluster_id", F.col("run_id").alias("_nr"),
        F.col("cluster_version").alias("_nv"), F.col("display_name").alias("name"),
        "naming_method", F.col("updated_at").alias("_nt"),
    )
    exact_run, exact_version = F.col("_nr") == F.col("run_id"), F.col("_nv") == F.col("cluster_version")
    c = clusters.alias("c")
    on = (F.col("c.field_name") == F.col("n.field_name")) & (F.col("c.cluster_id") == F.col("n.cluster_id"))
    if mode == "tolerant":
        on &= exact_run | F.col("_nr").isNull() | F.col("run_id").isNull()
        on &= exact_version | F.col("_nv").isNull() | F.col("cluster_version").isNull()
    else:
        on &= exact_run & exact_version
    joined = c.join(n.alias("n"), on, "left").drop(F.col("n.field_name"), F.col("n.cluster_id"))
    if not keep_all:
        keys = ["field_name", "cluster_id", "run_id", "cluster_version"]
        joined = latest_per_key(
            joined, keys,
            [F.coalesce(exact_version, F.lit(False)).desc(), F.coalesce(exact_run, F.lit(False)).desc(),
             F.col("_nt").desc_nulls_last(), F.col("name")],
        )
    return joined.drop("_nr", "_nv", "_nt")


def shown_name() -> Column:
    """First non-empty of names table, cluster table, cluster id."""
    empty = F.lit("")
    return F.coalesce(F.nullif("name", empty), F.nullif("display_name", empty), F.col("cluster_id"))


def with_thresholds(
    clusters: DataFrame, overrides: dict[str, float] | None = None, default: float = EXISTING_THRESHOLD
) -> DataFrame:
    """Field override, else the cluster's threshold, else the default."""
    for field, value in (overrides or {}).items():
        if not 0.0 <= value <= 1.0:
            raise ValueError(f"threshold of {field} is not between 0 and 1: {value}")
    own = F.coalesce(F.col("similarity_threshold"), F.lit(default))
    if overrides:
        lookup = F.create_map(*[F.lit(x) for pair in overrides.items() for x in pair])
        own = F.coalesce(F.try_element_at(lookup, F.col("field_name")), own)
    return clusters.withColumn("threshold", own.cast("double"))


def load_exact_map(
    label_map: DataFrame, clusters: DataFrame, names: DataFrame, anomaly: bool,
    fields: list[str] | None = None,
) -> DataFrame:
    """One cluster per (field, normalized label); the cluster's flag decides, not the map's.

    Highest count wins, then cluster id, then run.
    """
    m = label_map.filter(
        F.col("normalized_label").isNotNull() & (F.col("normalized_label") != "")
        & F.col("final_cluster_id").isNotNull()
    )
    if fields is not None:
        m = m.filter(F.col("field_name").isin(fields))
    m = m.select(
        "field_name", F.col("final_cluster_id").alias("cluster_id"),
        version_or_v1().alias("map_version"), normalize_label(F.col("normalized_label"), "mapper").alias("normalized_label"),
        F.coalesce("value_count", F.lit(0)).alias("value_count"), F.col("run_id").alias("map_run"),
    )
    c = with_names(active_clusters(clusters, anomaly=anomaly, with_centroid=False), names)
    c = c.select(
        "field_name", "cluster_id", version_or_v1().alias("map_version"),
        shown_name().alias("display_name"), "cluster_size", "total_occurrences",
    )
    joined = m.join(c, ["field_name", "cluster_id", "map_version"])
    return latest_per_key(
        joined, ["field_name", "normalized_label"],
        [F.col("value_count").desc(), F.col("cluster_id"), F.col("map_run")],
    ).select(
        "field_name", "normalized_label", "cluster_id", "display_name",
        F.col("map_version").alias("cluster_version"), F.lit(anomaly).alias("is_anomaly"),
    )


def exact_map_join(labels: DataFrame, std_map: DataFrame, anom_map: DataFrame) -> DataFrame:
    """Standard map first, then the anomaly map; columns ``exact_*``, null when unmatched."""
    on = ["field_name", "normalized_label"]

    def side(df: DataFrame, tag: str) -> DataFrame:
        value = F.struct("cluster_id", "display_name", "cluster_version", "is_anomaly")
        return df.select(*on, value.alias(tag))

    hit = F.coalesce("_std", "_anom")
    return (
        labels.join(side(std_map, "_std"), on, "left")
        .join(side(anom_map, "_anom"), on, "left")
        .withColumns(
            {
                "exact_cluster_id": hit["cluster_id"],
                "exact_display_name": hit["display_name"],
                "exact_version": hit["cluster_version"],
                "exact_is_anomaly": hit["is_anomaly"],
            }
        )
        .drop("_std", "_anom")
    )


def cluster_targets(clusters: DataFrame, names: DataFrame, overrides: dict | None = None) -> DataFrame:
    """Active clusters as match targets: unit centroid, threshold, name, guard masks."""
    c = with_thresholds(with_names(active_clusters(clusters), names), overrides)
    c = c.select(
        "field_name", "cluster_id", version_or_v1().alias("cluster_version"),
        F.when(is_anomaly(), "anomaly").otherwise("standard").alias("source"),
        shown_name().alias("display_name"), "medoid_label", "threshold",
        F.concat_ws("|", "cluster_id", version_or_v1()).alias("target_id"),
        V.l2_normalize(V.as_double(F.col("centroid_embedding"))).alias("centroid"),
    )
    text = F.concat_ws(" ", "display_name", "display_name", F.coalesce("medoid_label", F.lit("")))
    c = pin(c, {"_norm": normalize_label(text, "mapper")})
    return cut(guards.with_masks(c, "_norm", "target_opposites", "target_actors").drop("_norm"))


def rank_candidates(
    labels: DataFrame, targets: DataFrame, k: int = 5, label_id: str = "label_id"
) -> DataFrame:
    """Best ``k`` clusters per label and source, and the best one without actor conflict.

    ``labels`` has an id that is unique per field, field, raw and normalized label and a
    unit ``embedding``. The best allowed cluster is found even beyond the first ``k``.
    """
    text = F.concat_ws(" ", "raw_label", "normalized_label")
    q = pin(labels, {"_norm": normalize_label(text, "mapper")})
    q = guards.with_masks(q, "_norm", "_opp", "_act")
    ranked = best_targets(
        q, targets, ["field_name"], k, (label_id, "embedding", "_act"),
        ("target_id", "centroid", "target_actors"), target_groups=["source"],
    )
    facts = targets.select(
        "field_name", "source", F.col("target_id").alias("t_id"), "cluster_id",
        "cluster_version", "display_name", "medoid_label", "threshold",
    )
    return ranked.join(facts, ["field_name", "source", "t_id"]).select(
        "field_name", F.col("q_id").alias(label_id), "source", "cluster_id",
        F.col("sim").alias("similarity"), "rank", F.col("conflict").alias("actor_conflict"),
        "ok_first", "cluster_version", "display_name", "medoid_label", "threshold",
    )


def mapping_status(
    labels: DataFrame,
    ranked: DataFrame,
    targets: DataFrame,
    k: int = 5,
    label_id: str = "label_id",
    anomaly_threshold: float = ANOMALY_THRESHOLD,
    candidate_threshold: float = CANDIDATE_THRESHOLD,
) -> DataFrame:
    """Status, method, mapped cluster and candidates of labels without an exact match."""
    on = ["field_name", label_id]
    best = F.struct("similarity", "cluster_id", "display_name", "cluster_version", "threshold")
    candidate = F.struct(
        "rank", "cluster_id", "display_name", F.col("similarity").alias("similarity_score"),
        F.col("threshold").alias("similarity_threshold"), "medoid_label", "source",
        F.col("actor_conflict").alias("actor_direction_conflict"),
    )

    def of(source: str):
        mine = F.col("source") == source
        return (
            F.max(F.when(mine & F.col("ok_first"), best)),
            F.array_sort(F.collect_list(F.when(mine & (F.col("rank") <= k), candidate))),
        )

    std, std_list = of("standard")
    anom, anom_list = of("anomaly")
    per_label = ranked.groupBy(*on).agg(
        std.alias("std"), anom.alias("anom"), std_list.alias("std_list"), anom_list.alias("anom_list")
    )
    fields = targets.select("field_name").distinct().withColumn("has_reference", F.lit(True))
    df = labels.join(fields, "field_name", "left").join(per_label, on, "left")
    s, a = F.col("std"), F.col("anom")
    has_ref = F.coalesce("has_reference", F.lit(False))
    existing = F.coalesce(s["similarity"] >= s["threshold"], F.lit(False))
    known = F.coalesce(a["similarity"] >= anomaly_threshold, F.lit(False))
    near = F.coalesce(s["similarity"] >= candidate_threshold, F.lit(False))

    def pick(on_existing, on_known, otherwise):
        return F.when(existing, on_existing).when(known, on_known).otherwise(otherwise)

    none = F.lit(None)
    empty = F.array().cast(df.schema["std_list"].dataType)
    lists = [F.coalesce(c, empty) for c in ("std_list", "anom_list")]
    columns = {
        "mapping_status": F.when(~has_ref, NO_REFERENCE).when(existing, EXISTING)
        .when(known, KNOWN_ANOMALY).when(near, CANDIDATE).otherwise(TRUE_ANOMALY),
        "mapping_method": F.when(~has_ref, "no_active_cluster_reference")
        .when(existing, "centroid_similarity").when(known, "anomaly_centroid_similarity")
        .when(near, "near_existing_below_threshold").otherwise("low_similarity_unresolved"),
        "mapped_cluster_id": pick(s["cluster_id"], a["cluster_id"], none),
        "mapped_display_name": pick(s["display_name"], a["display_name"], none),
        "similarity_score": pick(
            s["similarity"], a["similarity"], F.coalesce(s["similarity"], a["similarity"])
        ),
        "existing_cluster_threshold": pick(
            s["threshold"], F.lit(anomaly_threshold),
            F.coalesce(s["threshold"], F.when(a.isNotNull(), F.lit(anomaly_threshold))),
        ),
        "cluster_version": pick(
            s["cluster_version"], a["cluster_version"],
            F.coalesce(s["cluster_version"], a["cluster_version"]),
        ),
        "top_candidates": F.when(
            ~existing & known, F.concat(lists[1], lists[0])
        ).when(existing, lists[0]).otherwise(F.concat(*lists)),
    }
    return df.withColumns(columns).drop("std", "anom", "std_list", "anom_list", "has_reference")


def exact_status(matched: DataFrame) -> DataFrame:
    """Status columns of labels that an exact map resolved: score and threshold 1."""
    anomaly = F.col("exact_is_anomaly")
    return matched.withColumns(
        {
            "mapping_status": F.when(anomaly, KNOWN_ANOMALY).otherwise(EXISTING),
            "mapping_method": F.when(anomaly, "exact_anomaly_label_map").otherwise("exact_label_map"),
            "mapped_cluster_id": F.col("exact_cluster_id"),
            "mapped_display_name": F.col("exact_display_name"),
            "similarity_score": F.lit(1.0),
            "existing_cluster_threshold": F.lit(1.0),
            "cluster_version": F.col("exact_version"),
        }
    )


def semantic_match(
    labels: DataFrame,
    targets: DataFrame,
    label_id: str = "label_id",
    threshold: float = EXISTING_THRESHOLD,
    margin: float = SEMANTIC_MARGIN,
) -> DataFrame:
    """Best cluster of the field, standard or anomaly, if the evidence is safe.

    Rejected, in this order: no index or vector, zero vector, below the threshold, runner-up too close,
    actor conflict, contradiction. The five best stay as evidence.
    """
    on = ["field_name", label_id]
    ranked = best_targets(
        labels, targets, ["field_name"], 5, (label_id, "embedding", None), ("target_id", "centroid", None)
    ).filter(F.col("rank") <= 5)
    t = targets.select(
        "field_name", F.col("target_id").alias("t_id"), "cluster_id", "display_name", "medoid_label", "source"
    )
    t = pin(t, {"_tn": F.coalesce(normalize_label(
        F.concat_ws(" ", "display_name", "medoid_label"), "loose"), F.lit(""))})
    t = guards.with_masks(t, "_tn", "_topp", "_tact").drop("_tn")
    top = (
        ranked.join(t, ["field_name", "t_id"])
        .groupBy("field_name", F.col("q_id").alias(label_id))
        .agg(
            F.array_sort(F.collect_list(F.struct(
                "rank", "cluster_id", "display_name",
                F.col("sim").alias("similarity"), F.col("source").alias("kind"), "medoid_label",
                "_topp", "_tact"))).alias("top")
        )
    )
    q = pin(labels, {"_qn": F.coalesce(normalize_label(F.col("raw_label"), "loose"), F.lit(""))})
    q = guards.with_masks(q, "_qn", "_qopp", "_qact").drop("_qn")
    best, second = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    gap = F.round(best["similarity"] - second["similarity"], 9)
    has_length = F.exists("embedding", lambda x: x != 0)
    reason = (
        F.when(F.col("top").isNull(), "missing_field_semantic_index_or_label_embedding")
        .when(~has_length, "zero_label_embedding")
        .when(best["similarity"] < threshold, "best_similarity_below_threshold")
        .when(gap < margin, "semantic_top_candidate_not_stable")
        .when(guards.masks_conflict(F.col("_qact"), best["_tact"]), "actor_direction_conflict")
        .when(guards.masks_contradict(F.col("_qopp"), best["_topp"]), "contradiction_guard_blocked")
        .otherwise("accepted_semantic_match")
    )
    df = q.join(top, on, "left").withColumn("reason", reason)
    accepted = F.col("reason") == "accepted_semantic_match"
    return df.withColumns(
        {
            "accepted": accepted,
            "match_cluster_id": F.when(accepted, best["cluster_id"]),
            "match_kind": F.when(accepted, best["kind"]),
            "match_display_name": F.when(accepted, best["display_name"]),
            "best_similarity": best["similarity"],
            "second_similarity": second["similarity"],
            "top_margin": gap,
            "top_candidates": F.transform(
                "top", lambda x: F.struct(x["cluster_id"], x["display_name"], x["similarity"])
            ),
        }
    ).drop("top", "_qopp", "_qact")


def mapping_summary(results: DataFrame) -> DataFrame:
    """Rows per field, status and method."""
    return results.groupBy("field_name", "mapping_status", "mapping_method").agg(
        F.count("*").alias("n_rows")
    )


def status_counts(results: DataFrame) -> DataFrame:
    """Nested counts: one row per field with a status-to-count map."""
    per = results.groupBy("field_name", "mapping_status").agg(F.count("*").alias("n"))
    entry = F.struct("mapping_status", "n")
    return per.groupBy("field_name").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("counts")
    )


def nearest_anomaly(groups: DataFrame, targets: DataFrame, group_id: str = "group_id") -> DataFrame:
    """Nearest active anomaly cluster of a group without actor conflict."""
    mine = targets.filter("source = 'anomaly'")
    text = F.concat_ws(" ", "normalized_label", F.array_join(F.slice("raw_labels", 1, 5), " "))
    q = pin(groups, {"_norm": normalize_label(text, "weekly")})
    q = guards.with_masks(q, "_norm", "_opp", "_act")
    best = best_targets(
        q, mine, ["field_name"], 1, (group_id, "centroid", "_act"),
        ("target_id", "centroid", "target_actors"),
    ).filter("ok_first")
    t = mine.select(
        "field_name", F.col("target_id").alias("t_id"), F.col("cluster_id").alias("anomaly_cluster_id"),
        F.col("display_name").alias("anomaly_name"),
    )
    return best.join(t, ["field_name", "t_id"]).select(
        "field_name", F.col("q_id").alias(group_id), "anomaly_cluster_id", "anomaly_name", F.col("sim").alias("anomaly_similarity"),
    )

