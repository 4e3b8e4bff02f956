"""Weekly maintenance: unresolved labels, safe mapping, counters, promotion, repair.

Groups can be huge (one label may hold a third of all rows), so nothing collects the rows
of a group: numbers aggregate map-side, lists are cut by rank before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import guards, names as N
from ..functions import vectors as V
from ..functions.keys import cluster_id_for
from ..functions.lists import (
    ANOMALY_THRESHOLD, CANDIDATE, DEFAULT_PROMOTION, EXISTING, EXISTING_THRESHOLD,
    KNOWN_ANOMALY, NO_REFERENCE, PROMOTION_LIMITS, SAFE_MAP_CLOSE, SAFE_MAP_SHARE,
    SEMANTIC_MARGIN, TRUE_ANOMALY,
)
from ..functions.text import normalize_label, pin, strip
from ..lineage import cut
from ..sources.io import latest_per_key, update_or_insert, window_rows
from .blocks import best_targets
from .mapping import is_active, is_anomaly, nearest_anomaly
from .vector_mean import mean_vectors

GROUP = ["field_name", "normalized_label"]
#: As many targets of a group as there are.
ALL_PAIRS = 1 << 30


EVENT_TIMES = ["classified_at", "created_at"]


def event_time() -> Column:
    return F.coalesce(*EVENT_TIMES)


def in_window(outputs: DataFrame, start, end) -> DataFrame:
    return window_rows(outputs, EVENT_TIMES, start, end, reject_empty=False)


def group_rows(outputs: DataFrame, statuses: list[str], start, end) -> DataFrame:
    """Rows of the window with one of the statuses and a weekly normal form."""
    return (
        in_window(outputs, start, end)
        .filter(F.col("mapping_status").isin(statuses) & (F.col("normalized_label") != ""))
        .withColumn("normalized_label", normalize_label(F.col("normalized_label"), "weekly"))
        .filter(F.col("normalized_label") != "")
        .withColumn("event_time", event_time())
    )


def _first(df: DataFrame, keys: list[str], order: list[Column], n: int | None, value: str, out: str) -> DataFrame:
    """Array of the first ``n`` values per key, or of all."""
    if n is None:
        return df.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(out))
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    return ranked.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_rn", value))).getField(value).alias(out)
    )


def group_ids(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """All distinct record or run ids of the groups, a row each: the full list behind a group's preview."""
    return rows.filter(F.col(value) != "").select(*keys, value).distinct()


def label_groups(rows: DataFrame, keys: list[str], id_limit: int | None = None) -> DataFrame:
    """Numbers, examples, ids and representative label of each group of output rows.

    ``record_ids`` and ``run_ids`` hold all distinct ids; with ``id_limit`` they are previews, and ``group_ids``
    has the whole lists as rows.
    """
    raw = F.coalesce("raw_label", F.lit(""))
    per_raw = cut(
        rows.withColumn("_raw", raw)
        .groupBy(*keys, "_raw")
        .agg(
            F.count("*").alias("n"),
            F.sum("similarity_score").alias("s"),
            F.count("similarity_score").alias("sn"),
            F.max("similarity_score").alias("mx"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
            F.max(F.col("mapping_status") == TRUE_ANOMALY).alias("has_true"),
            F.min("mapping_status").alias("status"),
        )
    )
    numbers = per_raw.groupBy(*keys).agg(
        F.sum("n").alias("row_count"),
        (F.sum("s") / F.sum("sn")).alias("avg_similarity"),
        F.max("mx").alias("max_similarity"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.when(F.max("has_true"), F.lit(TRUE_ANOMALY)).otherwise(F.min("status")).alias("primary_status"),
        F.min(F.when(strip(F.col("_raw")) != "", F.struct((-F.col("n")).alias("c"), "_raw")))
        .getField("_raw").alias("representative"),
    )
    named = per_raw.filter(strip(F.col("_raw")) != "")
    examples = _first(named, keys, [F.col("first_seen"), F.col("_raw")], 10, "_raw", "raw_labels")
    calls = group_ids(rows, keys, "source_record_id")
    call_numbers = calls.groupBy(*keys).agg(F.count("*").alias("distinct_call_count"))
    call_ids = _first(calls, keys, [F.col("source_record_id")], id_limit, "source_record_id", "record_ids")
    runs = group_ids(rows, keys, "mapper_run_id")
    run_ids = _first(runs, keys, [F.col("mapper_run_id")], id_limit, "mapper_run_id", "run_ids")
    out = numbers
    for part in (examples, call_numbers, call_ids, run_ids):
        out = out.join(part, keys, "left")
    return out.withColumns(
        {
            "representative": F.coalesce("representative", "normalized_label"),
            "distinct_call_count": F.coalesce("distinct_call_count", F.lit(0)),
        }
    )


def group_centroids(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Unit mean of the unit label vectors of each group."""
    vec = V.parse_vector(F.col("label_embedding"), "unit", is_array=True)
    usable = rows.select(*keys, vec.alias("_v")).filter(F.col("_v").isNotNull())
    return mean_vectors(usable, keys, "_v").select(
        *keys, V.l2_normalize(F.col("mean")).alias("centroid")
    )


def unresolved_groups(outputs: DataFrame, start, end) -> DataFrame:
    return label_groups(group_rows(outputs, [TRUE_ANOMALY, CANDIDATE], start, end), GROUP)


def known_anomaly_groups(outputs: DataFrame, start, end) -> DataFrame:
    """Evidence per field, known anomaly cluster and label; version and name of the earliest row
    of the cluster."""
    rows = group_rows(outputs, [KNOWN_ANOMALY], start, end).filter("mapped_cluster_id IS NOT NULL")
    keys = ["field_name", "mapped_cluster_id", "normalized_label"]
    order = F.struct("normalized_label", "event_time", "source_record_id")
    meta = rows.groupBy("field_name", "mapped_cluster_id").agg(
        F.min_by(F.struct("cluster_version", "mapped_display_name"), order).alias("m")
    )
    return (
        label_groups(rows, keys)
        .join(meta, ["field_name", "mapped_cluster_id"])
        .withColumns(
            {
                "cluster_version": F.coalesce("m.cluster_version", F.lit("weekly")),
                "display_name": F.col("m.mapped_display_name"),
            }
        )
        .drop("m")
    )


# -- candidates of a group ----------------------------------------------------------------


def candidate_stats(rows: DataFrame) -> DataFrame:
    """Scores per group and candidate cluster, over all candidates of all rows."""
    each = rows.select(
        *GROUP, "event_time", "source_record_id", F.posexplode_outer("top_candidates").alias("pos", "c")
    ).filter(F.col("c.cluster_id").isNotNull())
    first = F.min_by(F.col("c"), F.struct("event_time", "source_record_id", "pos"))
    return each.groupBy(*GROUP, F.col("c.cluster_id").alias("cluster_id")).agg(
        F.avg("c.similarity_score").alias("avg_score"),
        F.max("c.similarity_score").alias("max_score"),
        F.count("*").alias("n"),
        first.alias("first"),
    )


def top_standard_candidate(stats: DataFrame) -> DataFrame:
    """Best candidate cluster of each group by mean score, then count, then id."""
    totals = stats.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    best = latest_per_key(
        stats, GROUP,
        [F.round("avg_score", 9).desc_nulls_last(), F.col("n").desc(), F.col("cluster_id")],
    )
    return best.join(totals, GROUP).select(
        *GROUP, "cluster_id", "avg_score", "max_score", "n",
        (F.col("n") / F.col("total")).alias("stability_ratio"),
        F.col("first.display_name").alias("candidate_name"),
        F.col("first.medoid_label").alias("candidate_medoid"),
        F.col("first.similarity_threshold").alias("candidate_threshold"),
        F.col("first.similarity_score").alias("first_score"),
    )


def candidate_margin(stats: DataFrame) -> DataFrame:
    """Best score less the second best cluster's best score; null below two clusters."""
    w = Window.partitionBy(*GROUP).orderBy(F.col("max_score").desc(), F.col("cluster_id"))
    two = (
        stats.filter("max_score IS NOT NULL")
        .withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= 2)
    )
    return two.groupBy(*GROUP).agg(
        F.when(F.count("*") == 2, F.max("max_score") - F.min("max_score")).alias("top_margin")
    )


def safe_map_check(groups: DataFrame, stats: DataFrame) -> DataFrame:
    """All checks of the deterministic mapping of a group to its best standard candidate.

    With five candidates per row the share is near 0.2, so it seldom passes; that is kept.
    """
    df = groups.join(top_standard_candidate(stats), GROUP).join(candidate_margin(stats), GROUP, "left")
    label_text = F.concat_ws(" ", "normalized_label", F.array_join(F.slice("raw_labels", 1, 5), " "))
    target_text = F.concat_ws(" ", "candidate_name", "candidate_medoid")
    df = pin(
        df,
        {
            "_ln": normalize_label(label_text, "weekly"),
            "_tn": normalize_label(target_text, "weekly"),
            "overlap": F.array_sort(
                F.array_intersect(guards.token_set(label_text), guards.token_set(target_text))
            ),
        },
    )
    df = guards.with_masks(df, "_ln", "_lo", "_la")
    df = guards.with_masks(df, "_tn", "_to", "_ta").drop("_ln", "_tn")
    score = F.coalesce("avg_score", "first_score", "avg_similarity")
    threshold = F.coalesce("candidate_threshold", F.lit(EXISTING_THRESHOLD))
    checks = {
        "score": score,
        "threshold": threshold,
        "close_to_threshold": F.coalesce(
            F.round(score, 9) >= F.round(threshold - SAFE_MAP_CLOSE, 9), F.lit(False)
        ),
        "stable_top_candidate": F.col("stability_ratio") >= SAFE_MAP_SHARE,
        "strong_margin": F.col("top_margin").isNull() | (F.round("top_margin", 9) >= SEMANTIC_MARGIN),
        "shares_key_components": F.size("overlap") > 0,
        "contradiction": guards.masks_contradict(F.col("_lo"), F.col("_to")),
        "actor_direction_conflict": guards.masks_conflict(F.col("_la"), F.col("_ta")),
    }
    df = df.withColumns(checks).drop("_lo", "_la", "_to", "_ta")
    passed = (
        F.col("close_to_threshold") & F.col("stable_top_candidate") & F.col("strong_margin")
        & F.col("shares_key_components") & ~F.col("contradiction") & ~F.col("actor_direction_conflict")
    )
    return df.withColumn("safe_map_passed", passed)


# -- counters and promotion ---------------------------------------------------------------


def cluster_labels(label_map: DataFrame) -> DataFrame:
    """Labels of each cluster with their summed counts."""
    return (
        label_map.filter("normalized_label <> '' AND final_cluster_id IS NOT NULL")
        .groupBy(*GROUP, F.col("final_cluster_id").alias("cluster_id"))
        .agg(F.sum(F.coalesce("value_count", F.lit(0))).alias("label_sum"))
    )


def cluster_counters(label_map: DataFrame, outputs: DataFrame) -> DataFrame:
    """Rows, calls, weeks, label counts and times per cluster, by label; not windowed.

    Outputs are reduced to one row per label, call and week before they meet the map. ``CallCounters`` keeps the same
    numbers up from week to week.
    """
    labels = cluster_labels(label_map)
    t = event_time()
    calls = outputs.groupBy(*GROUP, "source_record_id", F.date_trunc("week", t).alias("week")).agg(
        F.count("*").alias("n"), F.min(t).alias("first_seen"), F.max(t).alias("last_seen")
    )
    return (
        calls.join(labels, GROUP)
        .groupBy("field_name", "cluster_id")
        .agg(
            F.sum("n").alias("row_count"),
            F.countDistinct("source_record_id").alias("distinct_call_count"),
            F.countDistinct("week").alias("weeks_seen"),
            F.max("label_sum").alias("label_occurrence_sum"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
    )


def promotion_met(counters: DataFrame, limits: dict = PROMOTION_LIMITS) -> DataFrame:
    """Any of calls, occurrences and weeks at its limit; the reason lists those that are."""

    def limit(i: int) -> Column:
        col = F.lit(DEFAULT_PROMOTION[i])
        for field, values in limits.items():
            col = F.when(F.col("field_name") == field, F.lit(values[i])).otherwise(col)
        return col

    occurrences = F.greatest("row_count", "label_occurrence_sum")
    parts = []
    for name, value, i in (
        ("distinct_call_count", F.col("distinct_call_count"), 0),
        ("occurrence_count", occurrences, 1),
        ("weeks_seen", F.col("weeks_seen"), 2),
    ):
        text = F.concat_ws("", F.lit(f"{name} "), value.cast("string"), F.lit(" >= "), limit(i).cast("string"))
        parts.append(F.when(value >= limit(i), text))
    return counters.withColumn("promotion_reason", F.concat_ws("; ", *parts)).withColumn(
        "promotion_met", F.col("promotion_reason") != ""
    )


def duplicate_standard_names(names: DataFrame, clusters: DataFrame) -> DataFrame:
    """Active standard clusters of one field that share a trimmed, lower-case name."""
    taken = standard_names(names, clusters)
    shared = taken.groupBy("field_name", "key").agg(F.countDistinct("cluster_id").alias("n")).filter("n > 1")
    return taken.join(shared.select("field_name", "key", "n"), ["field_name", "key"])


def standard_names(names: DataFrame, clusters: DataFrame) -> DataFrame:
    """Names in use: of active standard clusters, or of clusters that are not listed."""
    c = clusters.select("field_name", "cluster_id", is_active().alias("_act"), is_anomaly().alias("_an"))
    c = c.groupBy("field_name", "cluster_id").agg(F.max(F.col("_act") & ~F.col("_an")).alias("_ok"))
    key = F.lower(F.trim("display_name"))
    return (
        names.filter(F.trim(F.coalesce("display_name", F.lit(""))) != "")
        .join(c, ["field_name", "cluster_id"], "left")
        .filter(F.coalesce("_ok", F.lit(True)))
        .select("field_name", "cluster_id", "display_name", key.alias("key"))
        .distinct()
    )


def resolve_names(candidates: DataFrame, names: DataFrame, clusters: DataFrame) -> DataFrame:
    """Final standard name of each promotion candidate, null when it is already taken.

    ``candidates`` has field_name, cluster_id, proposed, representative. Of two candidates
    of one name the smaller cluster id gets it.
    """
    clean = F.coalesce(
        F.nullif(N.sanitize_name(F.col("proposed")), F.lit("")), N.display_name(F.col("representative"))
    )
    c = candidates.withColumn("resolved", clean).withColumn("name_key", N.name_key(F.col("resolved")))
    taken = standard_names(names, clusters).select(
        "field_name", N.name_key(F.col("display_name")).alias("name_key"), F.col("cluster_id").alias("_owner")
    )
    owners = taken.groupBy("field_name", "name_key").agg(
        F.min("_owner").alias("_lo"), F.max("_owner").alias("_hi")
    )
    first = Window.partitionBy("field_name", "name_key").orderBy("cluster_id")
    blocked = F.coalesce(
        (F.col("_lo") != F.col("cluster_id")) | (F.col("_hi") != F.col("cluster_id")), F.lit(False)
    )
    return (
        c.join(owners, ["field_name", "name_key"], "left")
        .withColumn("_blocked", blocked)
        .withColumn("_turn", F.row_number().over(first))
        .withColumn("standard_name", F.when(~F.col("_blocked") & (F.col("_turn") == 1), F.col("resolved")))
        .drop("_lo", "_hi", "_blocked", "_turn", "resolved", "name_key")
    )


# -- configuration repair -------------------------------------------------------------------


def config_issue_fields(outputs: DataFrame, start, end) -> DataFrame:
    return (
        in_window(outputs, start, end)
        .filter(F.col("mapping_status") == NO_REFERENCE)
        .groupBy("field_name")
        .agg(
            F.count("*").alias("row_count"),
            F.countDistinct("source_record_id").alias("distinct_call_count"),
            F.min("classified_at").alias("first_seen"),
            F.max("classified_at").alias("last_seen"),
        )
    )


def cluster_counts(clusters: DataFrame) -> DataFrame:
    active, standard = is_active(), ~is_anomaly()
    return clusters.groupBy("field_name").agg(
        F.count("*").alias("total_clusters"),
        F.count_if(active).alias("active_clusters"),
        F.count_if(active & standard).alias("active_standard_clusters"),
        F.count_if(standard).alias("standard_clusters"),
        F.count_if(standard & F.col("centroid_embedding").isNull()).alias("standard_missing_centroids"),
    )


def approved_fields(df: DataFrame, config: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of approved fields and of the others."""
    ok = config.filter("approved_for_production").select("field_name").distinct()
    return df.join(ok, "field_name", "left_semi"), df.join(ok, "field_name", "left_anti")


def repair_plan(fields: DataFrame, counts: DataFrame, config: DataFrame, status: str = "PLANNED") -> DataFrame:
    """Repair rows of each field that lacks clusters, in the order they would run."""
    ok = config.filter("approved_for_production").select("field_name", F.lit(True).alias("_ok")).distinct()
    df = fields.join(counts, "field_name", "left").join(ok, "field_name", "left")
    approved = F.coalesce("_ok", F.lit(False))
    total = F.coalesce("total_clusters", F.lit(0))

    def step(n: int, when: Column, issue: str, action: str, state: str) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(n).alias("step"), F.lit(issue).alias("issue_type"),
                F.lit(action).alias("repair_action"), F.lit(state).alias("repair_status"),
            ),
        )

    known = approved & (total > 0)
    steps = F.array_compact(
        F.array(
            step(1, ~approved, "FIELD_NOT_APPROVED_FOR_PRODUCTION",
                 "DISABLE_FROM_PRODUCTION_MAPPER_FIELD_CONFIG", status),
            step(2, approved & (total == 0), "NO_TAXONOMY_HISTORY", "INITIAL_TAXONOMY_BUILD_REQUIRED", "BLOCKED"),
            step(3, known & (F.col("active_standard_clusters") == 0) & (F.col("standard_clusters") > 0),
                 "NO_ACTIVE_STANDARD_CLUSTERS", "REACTIVATE_LATEST_VALID_STANDARD_CLUSTERS", status),
            step(4, known & (F.col("standard_missing_centroids") > 0), "MISSING_CENTROIDS",
                 "REBUILD_MISSING_CENTROIDS_AND_MEDOIDS", status),
            step(5, known, "NAME_COVERAGE_CHECK", "RESTORE_MISSING_NAMES_FROM_APPROVED_CLUSTER_METADATA", status),
        )
    )
    return df.select("field_name", F.inline(steps))


def reactivate_latest(clusters: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Newest version of standard clusters with a centroid becomes active, per field."""
    version = F.coalesce("cluster_version", "run_id", F.lit("v1"))
    valid = ~is_anomaly() & F.col("centroid_embedding").isNotNull()
    if fields is not None:
        valid &= F.col("field_name").isin(fields)
    newest = (
        clusters.filter(valid)
        .groupBy("field_name", version.alias("_version"))
        .agg(F.max(F.coalesce("updated_at", "created_at")).alias("_at"))
    )
    latest = latest_per_key(newest, ["field_name"], [F.col("_at").desc_nulls_last(), F.col("_version")])
    df = clusters.join(latest.drop("_at"), "field_name", "left")
    hit = valid & (version == F.col("_version"))
    return df.withColumn("active", F.when(F.coalesce(hit, F.lit(False)), True).otherwise(F.col("active"))).drop("_version")


def missing_names(clusters: DataFrame, names: DataFrame) -> DataFrame:
    """Name rows to restore: active standard clusters with an own name and no names row."""
    c = clusters.filter(is_active() & ~is_anomaly() & (F.coalesce("display_name", F.lit("")) != ""))
    keys = ["field_name", "cluster_id", "run_id", "cluster_version"]
    return c.join(names.select(*keys), keys, "left_anti").select(
        "field_name", "run_id",
        F.coalesce("cluster_version", "run_id", F.lit("weekly")).alias("cluster_version"),
        "cluster_id", is_anomaly().alias("is_anomaly"), "display_name",
        F.lit("weekly_restored_from_cluster").alias("naming_method"), F.lit(True).alias("active"),
    )


# -- resolver -------------------------------------------------------------------------------


@dataclass(frozen=True)
class State:
    clusters: DataFrame
    names: DataFrame
    label_map: DataFrame
    outputs: DataFrame
    embeddings: DataFrame | None = None


def own_cluster() -> Column:
    """Id of the anomaly cluster that a group gets for itself."""
    return cluster_id_for("weekly_anom", F.col("field_name"), F.col("normalized_label"))


def same_run_targets(groups: DataFrame, near: DataFrame, safe: DataFrame) -> DataFrame:
    """``near`` with the anomaly clusters that the groups of this run make themselves.

    As if groups came one after the other, the larger first (then by field and label): each is compared with the clusters
    there were and with those that groups before it have made, whose centre is that of their maker. True anomalies always
    make one, candidates that reach neither an anomaly cluster nor a safe one. Who makes one is found in rounds: a group
    with a maker before it among its neighbours does not, one whose neighbours before it all do not, does. ``groups`` has
    group_id, GROUP, primary_status, row_count, representative, raw_labels and centroid (null without vectors).
    """
    text = F.concat_ws(" ", "normalized_label", F.array_join(F.slice("raw_labels", 1, 5), " "))
    named = groups.withColumns({"_name": N.display_name(F.col("representative")), "_own": own_cluster(),
                                "_place": F.struct((-F.col("row_count")).alias("n"), "field_name", "normalized_label")})
    named = pin(named, {"_norm": normalize_label(text, "weekly"), "_shown": normalize_label(F.concat_ws(" ", "_name", "representative"), "weekly")})
    named = guards.with_masks(guards.with_masks(named, "_norm", "_opp", "_act"), "_shown", "_opp2", "_target_act")
    named = cut(named.join(near.select("group_id", F.lit(True).alias("_near")), "group_id", "left").join(
        safe.select("group_id", F.lit(True).alias("_safe")), "group_id", "left"))
    is_true = F.col("primary_status") == TRUE_ANOMALY
    may_make = named.filter(is_true | (F.col("_near").isNull() & F.col("_safe").isNull()))
    found = best_targets(
        named.filter(~is_true), may_make, ["field_name"], ALL_PAIRS, ("group_id", "centroid", "_act"),
        ("group_id", "centroid", "_target_act"), min_sim=ANOMALY_THRESHOLD).filter("NOT conflict AND q_id <> t_id")
    q = named.select(F.col("group_id").alias("q_id"), F.col("_place").alias("_q_place"))
    t = named.select(F.col("group_id").alias("t_id"), F.col("_place").alias("_t_place"))
    links = cut(found.select("q_id", "t_id", "sim").join(q, "q_id").join(t, "t_id").filter("_t_place < _q_place").select("q_id", "t_id", "sim"))
    makes = cut(may_make.select(F.col("group_id").alias("t_id"), F.when(is_true, F.lit(True)).alias("makes")))
    while not makes.filter("makes IS NULL").isEmpty():
        before = links.join(makes, "t_id").groupBy(F.col("q_id").alias("t_id")).agg(
            F.max(F.coalesce("makes", F.lit(False))).alias("_maker"), F.max(F.col("makes").isNull()).alias("_open"))
        now = F.when(F.col("_maker"), False).when(~F.coalesce("_open", F.lit(False)), True)
        makes = cut(makes.join(before, "t_id", "left").select("t_id", F.coalesce("makes", now).alias("makes")))
    made = links.join(makes.filter("makes"), "t_id").join(
        named.select(F.col("group_id").alias("t_id"), F.col("_own").alias("anomaly_cluster_id"), F.col("_name").alias("anomaly_name")), "t_id")
    both = near.select("field_name", "group_id", "anomaly_cluster_id", "anomaly_name", "anomaly_similarity").unionByName(
        made.join(named.select(F.col("group_id").alias("q_id"), "field_name"), "q_id").select(
            "field_name", F.col("q_id").alias("group_id"), "anomaly_cluster_id", "anomaly_name", F.col("sim").alias("anomaly_similarity")))
    return latest_per_key(both, ["group_id"], [F.col("anomaly_similarity").desc(), F.col("anomaly_cluster_id")])


def resolve_plan(outputs: DataFrame, targets: DataFrame, clusters: DataFrame, start, end, same_run: bool = False) -> DataFrame:
    """One planned action per group of the window.

    True anomalies get their own anomaly cluster; candidates attach to the nearest anomaly
    cluster, else map to a safe standard cluster, else get an anomaly cluster; known
    anomalies refresh theirs. All groups are planned from one snapshot of the state, with
    ``same_run`` also from the clusters that groups before them make (``same_run_targets``).
    """
    rows = cut(group_rows(outputs, [TRUE_ANOMALY, CANDIDATE], start, end))
    groups = cut(label_groups(rows, GROUP).withColumn(
        "group_id", F.concat_ws("|", "field_name", "normalized_label")
    ))
    candidates = groups.filter(F.col("primary_status") == CANDIDATE)
    centers = group_centroids(rows, GROUP)
    near = nearest_anomaly(candidates.join(centers, GROUP), targets).filter(
        F.col("anomaly_similarity") >= ANOMALY_THRESHOLD
    )
    standard = clusters.filter(~is_anomaly()).select("field_name", "cluster_id").distinct()
    safe = (
        safe_map_check(candidates, candidate_stats(rows))
        .filter("safe_map_passed")
        .join(standard, ["field_name", "cluster_id"], "left_semi")
        .select("group_id", F.col("cluster_id").alias("safe_id"), "candidate_name", "score")
    )
    own = own_cluster()
    if same_run:
        near, safe = cut(near), cut(safe)
        near = same_run_targets(groups.join(centers, GROUP, "left"), near, safe)
    df = groups.join(near.drop("field_name"), "group_id", "left").join(safe, "group_id", "left")
    attach, mapped = F.col("anomaly_cluster_id").isNotNull(), F.col("safe_id").isNotNull()

    def pick(on_attach, on_map, otherwise):
        return F.when(attach, on_attach).when(mapped, on_map).otherwise(otherwise)

    plan = df.select(
        "field_name", "normalized_label", F.col("primary_status").alias("original_status"),
        pick(F.lit("ATTACH_TO_EXISTING_ANOMALY_CLUSTER"), F.lit("MAP_TO_EXISTING_CLUSTER"),
             F.lit("CREATE_OR_UPDATE_INDIVIDUAL_ANOMALY_CLUSTER")).alias("action"),
        pick(F.col("anomaly_cluster_id"), F.col("safe_id"), own).alias("target_cluster_id"),
        pick(F.col("anomaly_name"), F.coalesce("candidate_name", "safe_id"),
             N.display_name(F.col("representative"))).alias("target_name"),
        pick(F.col("anomaly_similarity"), F.col("score"), F.col("avg_similarity")).alias("similarity"),
        "representative", "row_count", "distinct_call_count", "first_seen", "last_seen",
    )
    known = known_anomaly_groups(outputs, start, end).select(
        "field_name", "normalized_label", F.lit(KNOWN_ANOMALY).alias("original_status"),
        F.lit("REFRESH_KNOWN_ANOMALY_AND_PROMOTE_IF_RECURRING").alias("action"),
        F.col("mapped_cluster_id").alias("target_cluster_id"),
        F.coalesce("display_name", "mapped_cluster_id").alias("target_name"),
        F.col("avg_similarity").alias("similarity"),
        "representative", "row_count", "distinct_call_count", "first_seen", "last_seen",
    )
    return plan.unionByName(known)


def _update_outputs(outputs: DataFrame, hits: DataFrame, keys: list[str], statuses: list[str],
                    new_status: str, method: str | Column) -> DataFrame:
    """Rows of the keys with one of the statuses get the hit's cluster, status and method."""
    h = hits.select(*keys, F.col("target_cluster_id").alias("_id"), F.col("target_name").alias("_name"),
                    (F.lit(method) if isinstance(method, str) else method).alias("_method"))
    joined = outputs.join(h, keys, "left")
    hit = F.col("_id").isNotNull() & F.col("mapping_status").isin(statuses)
    change = {
        "mapped_cluster_id": F.col("_id"), "mapped_display_name": F.col("_name"),
        "mapping_status": F.lit(new_status), "mapping_method": F.col("_method"),
    }
    changed = joined.withColumn("_hit", hit)
    return changed.select(
        *[
            F.when(F.col("_hit"), change[c]).otherwise(F.col(c)).alias(c) if c in change else F.col(c)
            for c in outputs.columns
        ]
    )


def map_to_existing(plan: DataFrame, label_map: DataFrame, outputs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Label map and outputs after the safe mappings of the plan."""
    hits = plan.filter("action = 'MAP_TO_EXISTING_CLUSTER'")
    rows = hits.select(
        "field_name", F.col("representative").alias("raw_label"), "normalized_label",
        F.greatest(F.lit(1), F.col("row_count")).alias("value_count"),
        F.col("target_cluster_id").alias("final_cluster_id"),
        F.lit("standard_cluster").alias("final_cluster_source"),
        F.lit(False).alias("final_is_true_anomaly"), F.col("target_cluster_id").alias("base_cluster_id"),
    )
    new_map = update_or_insert(label_map, rows, GROUP)
    return new_map, _update_outputs(
        outputs, hits, GROUP, [CANDIDATE], EXISTING, "weekly_safe_map_to_existing"
    )


def mark_anomaly_outputs(plan: DataFrame, outputs: DataFrame) -> DataFrame:
    """Unresolved and known rows of the planned labels become known anomalies; not windowed.

    One label has one target: anomaly actions before refreshes, then the smaller id.
    """
    hits = latest_per_key(
        plan.filter("action <> 'MAP_TO_EXISTING_CLUSTER'"), GROUP,
        [(F.col("original_status") == KNOWN_ANOMALY), F.col("target_cluster_id")],
    )
    method = F.when(
        F.col("action") == "CREATE_OR_UPDATE_INDIVIDUAL_ANOMALY_CLUSTER", "weekly_created_anomaly_cluster"
    ).otherwise("weekly_updated_anomaly_cluster")
    return _update_outputs(
        outputs, hits, GROUP, [TRUE_ANOMALY, CANDIDATE, KNOWN_ANOMALY], KNOWN_ANOMALY, method
    )


def upsert_anomaly_clusters(plan: DataFrame, state: State, start, end, version: str = "weekly") -> State:
    """Anomaly clusters, names, label map and outputs after the anomaly actions of the plan.

    Groups that hit one cluster are merged first. The centroid is the unit mean of the
    group rows' vectors and of the vectors of labels already in the cluster.
    """
    key = ["field_name", "target_cluster_id"]
    p = cut(plan.filter("action <> 'MAP_TO_EXISTING_CLUSTER'"))
    rows = group_rows(state.outputs, [TRUE_ANOMALY, CANDIDATE, KNOWN_ANOMALY], start, end)
    is_known = F.col("mapping_status") == KNOWN_ANOMALY
    planned = p.select(*GROUP, "target_cluster_id", "representative", "row_count",
                       (F.col("original_status") == KNOWN_ANOMALY).alias("_pk"))
    mine = rows.withColumn("_pk", is_known).join(planned, [*GROUP, "_pk"]).filter(
        ~F.col("_pk") | (F.col("mapped_cluster_id") == F.col("target_cluster_id"))
    )
    existing = state.label_map.select(
        "field_name", F.col("final_cluster_id").alias("target_cluster_id"), "raw_label",
        "normalized_label", F.coalesce("value_count", F.lit(1)).alias("value_count"),
    ).join(p.select(*key).distinct(), key)
    vec = V.parse_vector(F.col("label_embedding"), "unit", is_array=True)
    vectors = mine.select(*key, F.col("representative").alias("label"), vec.alias("v"))
    if state.embeddings is not None:
        e = state.embeddings.select(
            "field_name", "normalized_label",
            V.parse_vector(F.col("embedding"), "unit", is_array=True).alias("v"),
        )
        vectors = vectors.unionByName(
            existing.select(*key, "normalized_label").distinct().join(e, GROUP)
            .select(*key, F.col("normalized_label").alias("label"), "v")
        )
    vectors = cut(vectors.filter(F.col("v").isNotNull()))
    centers = mean_vectors(vectors, key, "v").select(*key, V.l2_normalize(F.col("mean")).alias("center"))
    sim = F.round(V.cosine(F.col("v"), F.col("center")), 9)
    medoids = vectors.join(centers, key).groupBy(*key).agg(
        F.first("center").alias("mean_v"), F.min(F.struct((-sim).alias("s"), "label")).alias("m")
    )
    counts = (
        existing.select(*key, "raw_label", F.col("value_count").alias("c"))
        .unionByName(
            mine.filter("raw_label <> ''").groupBy(*key, *GROUP[1:], "raw_label", "row_count")
            .agg(F.count("*").alias("n"))
            .select(*key, "raw_label", (F.col("n") * F.greatest(F.lit(1), F.col("row_count"))).alias("c"))
        )
        .groupBy(*key, "raw_label").agg(F.sum("c").alias("c"))
    )
    sizes = counts.groupBy(*key).agg(
        F.count("*").cast("int").alias("cluster_size"), F.sum("c").alias("total_occurrences")
    )
    reps = _first(counts, key, [F.col("c").desc(), F.col("raw_label")], 10, "raw_label", "representative_labels")
    new_map = update_or_insert(
        state.label_map,
        latest_per_key(p, GROUP, [F.col("original_status") == KNOWN_ANOMALY, F.col("target_cluster_id")]).select(
            "field_name", F.col("representative").alias("raw_label"), "normalized_label",
            F.greatest(F.lit(1), F.col("row_count")).alias("value_count"),
            F.col("target_cluster_id").alias("final_cluster_id"),
            F.lit("true_anomaly").alias("final_cluster_source"), F.lit(True).alias("final_is_true_anomaly"),
            F.lit("-1").alias("base_cluster_id"), F.lit(version).alias("cluster_version"),
        ),
        GROUP,
    )
    met = promotion_met(cluster_counters(new_map, state.outputs)).withColumnRenamed("cluster_id", "target_cluster_id")
    head = latest_per_key(p, key, [F.col("row_count").desc(), F.col("normalized_label")])
    new = (
        head.select(*key, "target_name", "representative")
        .join(medoids, key, "left").join(sizes, key, "left").join(reps, key, "left").join(met, key, "left")
        .select(
            "field_name", F.col("target_cluster_id").alias("cluster_id"),
            F.lit(version).alias("run_id"), F.lit(version).alias("cluster_version"),
            F.lit("true_anomaly").alias("cluster_source"), F.col("mean_v").alias("centroid_embedding"),
            F.coalesce("m.label", "representative").alias("medoid_label"),
            (-F.col("m.s")).alias("medoid_similarity_to_centroid"), "representative_labels",
            "cluster_size", "total_occurrences", F.lit(True).alias("is_true_anomaly_cluster"),
            F.lit(True).alias("active"), F.col("target_name").alias("display_name"),
            F.when(F.coalesce("promotion_met", F.lit(False)), "STANDARD_CLUSTER_PROMOTION_CANDIDATE")
            .otherwise("ACTIVE_TRUE_ANOMALY").alias("promotion_status"),
        )
    )
    new = cut(new)
    clusters = update_or_insert(
        state.clusters, new, ["field_name", "cluster_id"],
        keep=("created_at", "id", "run_id", "cluster_version", "similarity_threshold"),
    )
    name_rows = new.select(
        "field_name", "cluster_id", "run_id", "cluster_version", "display_name",
        F.lit("weekly_deterministic_anomaly_label").alias("naming_method"), F.lit(True).alias("is_anomaly"),
        F.lit(True).alias("active"),
    )
    new_names = update_or_insert(
        state.names, name_rows, ["field_name", "cluster_id"], keep=("created_at", "run_id", "cluster_version")
    )
    return State(clusters, new_names, new_map, mark_anomaly_outputs(plan, state.outputs), state.embeddings)


def promote(state: State, candidates: DataFrame) -> tuple[State, DataFrame]:
    """Promotion candidates become standard clusters unless their name is taken.

    Returns the new state and the candidates with their result.
    """
    key = ["field_name", "cluster_id"]
    resolved = cut(resolve_names(candidates, state.names, state.clusters).withColumn(
        "promotion_status",
        F.when(F.col("standard_name").isNotNull(), "PROMOTED_TO_STANDARD")
        .otherwise("STANDARD_CLUSTER_PROMOTION_BLOCKED_DUPLICATE_NAME"),
    ))
    r = resolved.select(*key, F.col("standard_name").alias("_n"), F.col("promotion_status").alias("_s"))
    joined = state.clusters.join(r, key, "left")
    won = F.col("_n").isNotNull()
    change = {
        "is_true_anomaly_cluster": F.when(won, False), "cluster_source": F.when(won, "promoted_from_true_anomaly"),
        "display_name": F.col("_n"), "active": F.when(won, True), "promotion_status": F.col("_s"),
    }
    clusters = joined.select(*[
        F.coalesce(change[c], F.col(c)).alias(c) if c in change else F.col(c) for c in state.clusters.columns
    ])
    winners = resolved.filter("standard_name IS NOT NULL")
    names = update_or_insert(
        state.names,
        winners.select(*key, F.col("standard_name").alias("display_name"),
                       F.lit("deterministic_promoted_standard_name").alias("naming_method"),
                       F.lit(False).alias("is_anomaly"), F.lit(True).alias("active")),
        key, keep=("created_at", "run_id", "cluster_version"),
    )
    w = winners.select("field_name", F.col("cluster_id").alias("final_cluster_id"), F.lit(True).alias("_w"))
    m = state.label_map.join(w, ["field_name", "final_cluster_id"], "left")
    on_map = {
        "final_cluster_source": F.when(F.col("_w"), "promoted_from_true_anomaly"),
        "final_is_true_anomaly": F.when(F.col("_w"), False),
        "base_cluster_id": F.when(F.col("_w"), F.col("final_cluster_id")),
    }
    label_map = m.select(*[
        F.coalesce(on_map[c], F.col(c)).alias(c) if c in on_map else F.col(c) for c in state.label_map.columns
    ])
    hits = winners.select(
        "field_name", F.col("cluster_id").alias("mapped_cluster_id"),
        F.col("cluster_id").alias("target_cluster_id"), F.col("standard_name").alias("target_name"),
    )
    outputs = _update_outputs(
        state.outputs, hits, ["field_name", "mapped_cluster_id"], [KNOWN_ANOMALY], EXISTING,
        "weekly_promoted_known_anomaly_cluster",
    )
    return State(clusters, names, label_map, outputs, state.embeddings), resolved


