"""Queries over weekly maintenance."""

import uuid

from pyspark.sql import functions as F

from ..functions.lists import ACRONYMS_WEEKLY
from ..lineage import checkpoint_dir, cut
from ..operators import mapping as M
from ..operators import weekly as W
from ..operators.call_counters import CallCounters
from ..oracles import expr as X
from ..oracles.fixtures import with_tables
from ..plans import maintenance
from ..registry import ENTRIES, query
from ..sources.days import read_days, write_days
from ..sources.keyed import KeyedTable
from .mapping import ACTIVE, ANOMALY, NAMED, SHOWN
from .tables import END, START, in_window

FMT = "yyyy-MM-dd HH:mm:ss"
TIMES = "strftime(min(classified_at), '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(max(classified_at), '%Y-%m-%d %H:%M:%S') AS last_seen"


def times(df):
    return df.withColumns({c: F.date_format(c, FMT) for c in ("first_seen", "last_seen")})


_GROUP_NUMBERS = f"""count(*) AS row_count, count(DISTINCT source_record_id) AS distinct_call_count,
  count(DISTINCT mapper_run_id) AS n_runs, round(sum(similarity_score::DOUBLE) / count(*), 6) AS avg_similarity,
  round(max(similarity_score)::DOUBLE, 6) AS max_similarity, min(raw_label) AS representative, {TIMES}"""


def group_numbers(df):
    return times(df).select(
        "field_name", "normalized_label", "primary_status", "row_count", "distinct_call_count",
        F.size("run_ids").cast("bigint").alias("n_runs"), F.round("avg_similarity", 6).alias("avg_similarity"),
        F.round("max_similarity", 6).alias("max_similarity"), "representative", "first_seen", "last_seen",
    )


@query(
    "unresolved_groups", "G6",
    with_tables(
        f"""SELECT field_name, normalized_label, max(CASE WHEN mapping_status = 'TRUE_ANOMALY' THEN 'TRUE_ANOMALY'
          ELSE 'NEW_CLUSTER_CANDIDATE' END) AS primary_status, {_GROUP_NUMBERS}
        FROM fx_outputs WHERE mapping_status IN ('TRUE_ANOMALY', 'NEW_CLUSTER_CANDIDATE') AND normalized_label <> ''
          AND {in_window('classified_at')} GROUP BY field_name, normalized_label""",
        "fx_outputs",
    ),
)
def _(t):
    return group_numbers(W.unresolved_groups(t.outputs(), START, END))


@query(
    "known_anomaly_groups", "G7",
    with_tables(
        f"""SELECT field_name, mapped_cluster_id, normalized_label, 'KNOWN_TRUE_ANOMALY' AS primary_status,
          any_value(mapped_display_name) AS display_name, 'v1' AS cluster_version, {_GROUP_NUMBERS}
        FROM fx_outputs WHERE mapping_status = 'KNOWN_TRUE_ANOMALY' AND normalized_label <> ''
          AND {in_window('classified_at')} GROUP BY field_name, mapped_cluster_id, normalized_label""",
        "fx_outputs",
    ),
)
def _(t):
    g = W.known_anomaly_groups(t.outputs(), START, END)
    extra = g.select("field_name", "mapped_cluster_id", "normalized_label", "display_name", "cluster_version")
    return group_numbers(g).join(extra, ["field_name", "normalized_label"])


_CAND = f"""SELECT * FROM fx_candidates WHERE mapping_status IN ('TRUE_ANOMALY', 'NEW_CLUSTER_CANDIDATE')
  AND normalized_label <> '' AND {in_window('classified_at')}"""
STATS_STEPS = {
    "cand": _CAND,
    "stats": """SELECT field_name, normalized_label, cand_id AS cluster_id, round(avg(cand_score), 9) AS avg_score,
        max(cand_score) AS max_score, count(*) AS n, any_value(cand_display) AS candidate_name,
        any_value(cand_medoid) AS candidate_medoid FROM cand GROUP BY ALL""",
    "top_cand": """SELECT *, n / sum(n) OVER (PARTITION BY field_name, normalized_label) AS stability_ratio FROM stats
        QUALIFY row_number() OVER (PARTITION BY field_name, normalized_label ORDER BY avg_score DESC, n DESC, cluster_id) = 1""",
    "margins": """SELECT field_name, normalized_label, CASE WHEN count(*) = 2 THEN max(max_score) - min(max_score) END AS top_margin
        FROM (SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY field_name, normalized_label
          ORDER BY max_score DESC, cluster_id) <= 2) GROUP BY ALL""",
}


def stats_of(t):
    rows = W.group_rows(t.outputs_with_candidates(), ["TRUE_ANOMALY", "NEW_CLUSTER_CANDIDATE"], START, END)
    return rows, W.candidate_stats(rows)


@query(
    "top_standard_candidate", "G8",
    with_tables(
        """SELECT field_name, normalized_label, cluster_id, round(avg_score, 6) AS avg_score, max_score, n,
          round(stability_ratio, 6) AS stability_ratio, candidate_name FROM top_cand""",
        "fx_candidates", **STATS_STEPS,
    ),
)
def _(t):
    return W.top_standard_candidate(stats_of(t)[1]).select(
        "field_name", "normalized_label", "cluster_id", F.round("avg_score", 6).alias("avg_score"), "max_score",
        "n", F.round("stability_ratio", 6).alias("stability_ratio"), "candidate_name",
    )


@query(
    "candidate_margin", "G9",
    with_tables(
        "SELECT field_name, normalized_label, round(top_margin, 6) AS top_margin FROM margins",
        "fx_candidates", **STATS_STEPS,
    ),
)
def _(t):
    return W.candidate_margin(stats_of(t)[1]).withColumn("top_margin", F.round("top_margin", 6))


SAFE_STEPS = STATS_STEPS | {
    "safe": """SELECT c.*, m.top_margin, c.avg_score >= round(0.82 - 0.025, 9) AS close_to_threshold,
        stability_ratio >= 0.8 AS stable_top_candidate, coalesce(round(m.top_margin, 9) >= 0.015, true) AS strong_margin,
        (split_part(c.normalized_label, ' ', 2) = split_part(candidate_name, ' ', 2) OR
          split_part(c.normalized_label, ' ', 2) = split_part(candidate_medoid, '_', 2))
          AND length(split_part(c.normalized_label, ' ', 2)) > 1 AS shares_key_components
      FROM top_cand c JOIN margins m USING (field_name, normalized_label)""",
}


@query(
    "safe_map_check", "G10 C14",
    with_tables(
        """SELECT field_name, normalized_label, cluster_id, close_to_threshold, stable_top_candidate, strong_margin,
          shares_key_components, false AS contradiction, false AS actor_direction_conflict,
          close_to_threshold AND stable_top_candidate AND strong_margin AND shares_key_components AS safe_map_passed
        FROM safe""",
        "fx_candidates", **SAFE_STEPS,
    ),
)
def _(t):
    rows, stats = stats_of(t)
    return W.safe_map_check(W.label_groups(rows, W.GROUP), stats).select(
        "field_name", "normalized_label", "cluster_id", "close_to_threshold", "stable_top_candidate",
        "strong_margin", "shares_key_components", "contradiction", "actor_direction_conflict", "safe_map_passed",
    )


COUNTER_STEPS = {
    "map_labels": """SELECT field_name, normalized_label, final_cluster_id AS cluster_id, sum(value_count) AS label_sum
      FROM fx_label_map GROUP BY ALL""",
    "counters": f"""SELECT o.field_name, l.cluster_id, count(*) AS row_count,
        count(DISTINCT source_record_id) AS distinct_call_count,
        count(DISTINCT date_trunc('week', classified_at)) AS weeks_seen,
        cast(max(label_sum) AS BIGINT) AS label_occurrence_sum, {TIMES}
      FROM fx_outputs o JOIN map_labels l USING (field_name, normalized_label) GROUP BY ALL""",
}


@query("cluster_counters", "G11", with_tables("SELECT * FROM counters", "fx_outputs", "fx_label_map", **COUNTER_STEPS))
def _(t):
    return times(W.cluster_counters(t.label_map(), t.outputs()))


@query("cluster_counters_by_week", "G11", ENTRIES["cluster_counters"].sql)
def _(t):
    """The same counters from bitmaps that are added week by week."""
    kept = CallCounters(t.spark, f"{checkpoint_dir(t.spark)}/counters-{uuid.uuid4().hex}", buckets=8)
    outputs = cut(t.outputs())
    week = F.date_format(F.date_trunc("week", W.event_time()), "yyyy-MM-dd")
    for (name,) in outputs.select(week).distinct().orderBy(week).collect():  # as many as there are weeks
        kept.add(outputs.filter(week.eqNullSafe(F.lit(name))), f"week-{name}")
    return times(kept.cluster_counters(t.label_map()))


@query("unresolved_by_day", "G6 A5", ENTRIES["unresolved_groups"].sql)
def _(t):
    """The groups of a window from a table laid out by day."""
    path = f"{checkpoint_dir(t.spark)}/days-{uuid.uuid4().hex}"
    write_days(t.outputs(), path, W.EVENT_TIMES)
    rows = read_days(t.spark, path, W.EVENT_TIMES, START, END)
    return group_numbers(W.unresolved_groups(rows, START, END))


@query(
    "resolve_chain", "G13 E16",
    """SELECT cast(c_custkey // 12 AS VARCHAR) AS field_name, 'g' || c_custkey % 12 AS normalized_label,
      CASE WHEN c_custkey % 12 % 2 = 1 THEN 'weekly_anom_' || left(sha256((c_custkey // 12) || '||g' || (c_custkey % 12 - 1)), 18) END AS attached_to
    FROM customer""",
)
def _(t):
    """Chains of groups, each similar to the one before it only: every second one makes a cluster, to which the next attaches."""
    k = F.col("c_custkey") % 12
    groups = t.given("customer").select(
        F.floor(F.col("c_custkey") / 12).cast("string").alias("field_name"), F.concat(F.lit("g"), k.cast("string")).alias("normalized_label"),
        F.lit("NEW_CLUSTER_CANDIDATE").alias("primary_status"), (100 - k).alias("row_count"), F.concat(F.lit("G "), k.cast("string")).alias("representative"),
        F.array(F.concat(F.lit("G "), k.cast("string"))).alias("raw_labels"), F.array(F.cos(k * 0.4), F.sin(k * 0.4)).alias("centroid"),
    ).withColumn("group_id", F.concat_ws("|", "field_name", "normalized_label"))
    none = "field_name string, group_id string, anomaly_cluster_id string, anomaly_name string, anomaly_similarity double"
    nothing = t.spark.createDataFrame([], none)
    found = W.same_run_targets(groups, nothing, nothing).select("group_id", F.col("anomaly_cluster_id").alias("attached_to"))
    return groups.join(found, "group_id", "left").select("field_name", "normalized_label", "attached_to")


@query(
    "promotion_met", "G12",
    with_tables(
        """SELECT field_name, cluster_id, concat_ws('; ',
            CASE WHEN distinct_call_count >= 10 THEN 'distinct_call_count ' || distinct_call_count || ' >= 10' END,
            CASE WHEN greatest(row_count, label_occurrence_sum) >= 25 THEN 'occurrence_count ' || greatest(row_count, label_occurrence_sum) || ' >= 25' END,
            CASE WHEN weeks_seen >= 2 THEN 'weeks_seen ' || weeks_seen || ' >= 2' END) AS promotion_reason,
          distinct_call_count >= 10 OR greatest(row_count, label_occurrence_sum) >= 25 OR weeks_seen >= 2 AS promotion_met
        FROM counters""",
        "fx_outputs", "fx_label_map", **COUNTER_STEPS,
    ),
)
def _(t):
    out = W.promotion_met(W.cluster_counters(t.label_map(), t.outputs()))
    return out.select("field_name", "cluster_id", "promotion_reason", "promotion_met")


STANDARD_NAMES = f"""SELECT DISTINCT n.field_name, n.cluster_id, n.display_name, lower(trim(n.display_name)) AS key
  FROM fx_names n LEFT JOIN fx_clusters c USING (field_name, cluster_id)
  WHERE coalesce(c.active, true) AND NOT coalesce(c.is_true_anomaly_cluster, false) AND trim(n.display_name) <> ''"""


@query(
    "duplicate_standard_names", "G16",
    with_tables(
        """SELECT *, n FROM (SELECT field_name, key, cluster_id, display_name,
          count(*) OVER (PARTITION BY field_name, key) AS n FROM sn) WHERE n > 1""".replace("*, n FROM", "* FROM"),
        "fx_names", "fx_clusters", sn=STANDARD_NAMES,
    ),
)
def _(t):
    return W.duplicate_standard_names(t.names(), t.clusters())


@query(
    "resolve_promotion_names", "G15 G16",
    with_tables(
        f"""SELECT field_name, cluster_id, CASE WHEN NOT blocked AND row_number() OVER (PARTITION BY field_name, k
          ORDER BY cluster_id) = 1 THEN resolved END AS standard_name FROM (
          SELECT *, EXISTS (SELECT 1 FROM sn WHERE sn.field_name = p.field_name AND sn.cluster_id <> p.cluster_id
            AND {X.name_key('sn.display_name')} = k) AS blocked FROM p)""",
        "fx_names", "fx_clusters", sn=STANDARD_NAMES, named=NAMED,
        p=f"""SELECT field_name, cluster_id, resolved, {X.name_key('resolved')} AS k FROM (
          SELECT field_name, cluster_id, {X.sanitize(SHOWN, ACRONYMS_WEEKLY)} AS resolved FROM named)""",
    ),
)
def _(t):
    c = M.with_names(t.clusters(), t.names()).select(
        "field_name", "cluster_id", M.shown_name().alias("proposed"), F.col("medoid_label").alias("representative")
    )
    return W.resolve_names(c, t.names(), t.clusters()).select("field_name", "cluster_id", "standard_name")


@query(
    "config_issue_fields", "G19",
    with_tables(
        f"""SELECT field_name, count(*) AS row_count, count(DISTINCT source_record_id) AS distinct_call_count, {TIMES}
        FROM fx_outputs WHERE mapping_status = 'NO_CLUSTER_REFERENCE' AND {in_window('classified_at')} GROUP BY field_name""",
        "fx_outputs",
    ),
)
def _(t):
    return times(W.config_issue_fields(t.outputs(), START, END))


COUNTS = f"""SELECT field_name, count(*) AS total_clusters, count(*) FILTER ({ACTIVE}) AS active_clusters,
  count(*) FILTER ({ACTIVE} AND NOT {ANOMALY}) AS active_standard_clusters,
  count(*) FILTER (NOT {ANOMALY}) AS standard_clusters,
  count(*) FILTER (NOT {ANOMALY} AND centroid_embedding IS NULL) AS standard_missing_centroids
  FROM fx_clusters GROUP BY field_name"""


@query("cluster_counts", "G20", with_tables(COUNTS, "fx_clusters"))
def _(t):
    return W.cluster_counts(t.clusters())


def field_config(t):
    return t.clusters().select("field_name", (F.col("field_name") != "field_1").alias("approved_for_production"))


@query(
    "approved_fields", "B4",
    with_tables(
        """SELECT field_name, field_name <> 'field_1' AS is_approved, count(*) AS n FROM fx_outputs GROUP BY ALL""",
        "fx_outputs",
    ),
)
def _(t):
    yes, no = W.approved_fields(t.outputs(), field_config(t))
    both = yes.withColumn("is_approved", F.lit(True)).unionByName(no.withColumn("is_approved", F.lit(False)))
    return both.groupBy("field_name", "is_approved").agg(F.count("*").alias("n"))


@query(
    "repair_plan", "G21",
    with_tables(
        """SELECT f.field_name, s.step, s.issue_type, s.repair_action, s.repair_status FROM fields f
        LEFT JOIN counts c USING (field_name), LATERAL (VALUES
          (1, f.field_name = 'field_1', 'FIELD_NOT_APPROVED_FOR_PRODUCTION', 'DISABLE_FROM_PRODUCTION_MAPPER_FIELD_CONFIG', 'PLANNED'),
          (2, f.field_name <> 'field_1' AND coalesce(total_clusters, 0) = 0, 'NO_TAXONOMY_HISTORY', 'INITIAL_TAXONOMY_BUILD_REQUIRED', 'BLOCKED'),
          (3, f.field_name <> 'field_1' AND total_clusters > 0 AND active_standard_clusters = 0 AND standard_clusters > 0,
            'NO_ACTIVE_STANDARD_CLUSTERS', 'REACTIVATE_LATEST_VALID_STANDARD_CLUSTERS', 'PLANNED'),
          (4, f.field_name <> 'field_1' AND total_clusters > 0 AND standard_missing_centroids > 0,
            'MISSING_CENTROIDS', 'REBUILD_MISSING_CENTROIDS_AND_MEDOIDS', 'PLANNED'),
          (5, f.field_name <> 'field_1' AND total_clusters > 0, 'NAME_COVERAGE_CHECK',
            'RESTORE_MISSING_NAMES_FROM_APPROVED_CLUSTER_METADATA', 'PLANNED')) s(step, wanted, issue_type, repair_action, repair_status)
        WHERE s.wanted""",
        "fx_outputs", "fx_clusters",
        fields=f"""SELECT DISTINCT field_name FROM fx_outputs WHERE mapping_status = 'NO_CLUSTER_REFERENCE'
          AND {in_window('classified_at')}""",
        counts=COUNTS,
    ),
)
def _(t):
    fields = W.config_issue_fields(t.outputs(), START, END)
    return W.repair_plan(fields, W.cluster_counts(t.clusters()), field_config(t))


@query(
    "reactivate_latest", "G22",
    with_tables(
        f"""SELECT c.id, CASE WHEN NOT {ANOMALY} AND centroid_embedding IS NOT NULL
            AND coalesce(cluster_version, run_id, 'v1') = l.v THEN true ELSE active END AS active
        FROM fx_clusters c LEFT JOIN latest l USING (field_name)""",
        "fx_clusters",
        latest=f"""SELECT field_name, v FROM (SELECT field_name, coalesce(cluster_version, run_id, 'v1') AS v,
            max(updated_at) AS latest_at FROM fx_clusters WHERE NOT {ANOMALY} AND centroid_embedding IS NOT NULL GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY field_name ORDER BY latest_at DESC, v) = 1""",
    ),
)
def _(t):
    return W.reactivate_latest(t.clusters()).select("id", "active")


@query(
    "missing_names", "E17",
    with_tables(
        f"""SELECT c.field_name, c.run_id, coalesce(c.cluster_version, c.run_id) AS cluster_version, c.cluster_id,
          c.display_name, 'weekly_restored_from_cluster' AS naming_method FROM fx_clusters c
        LEFT JOIN fx_names n USING (field_name, cluster_id, run_id, cluster_version)
        WHERE n.cluster_id IS NULL AND {ACTIVE.replace('active', 'c.active')} AND NOT {ANOMALY} AND c.display_name <> ''""".replace(
            "n.cluster_id IS NULL", "n.naming_method IS NULL"),
        "fx_clusters", "fx_names",
    ),
)
def _(t):
    return W.missing_names(t.clusters(), t.names()).drop("is_anomaly", "active")


# The resolver ------------------------------------------------------------------------------

PLAN_STEPS = SAFE_STEPS | {
    "named": NAMED,
    "grp": f"""SELECT field_name, normalized_label, k, min(raw_label) AS representative, count(*) AS row_count,
        max(mapping_status = 'TRUE_ANOMALY') AS is_true, round(sum(similarity_score::DOUBLE) / count(*), 6) AS avg_similarity
      FROM fx_outputs WHERE mapping_status IN ('TRUE_ANOMALY', 'NEW_CLUSTER_CANDIDATE') AND normalized_label <> ''
        AND {in_window('classified_at')} GROUP BY ALL""",
    "near": f"""SELECT g.field_name, g.normalized_label, c.cluster_id, {SHOWN.replace('cluster_id', 'c.cluster_id').replace('name,', 'c.name,', 1).replace('nullif(display_name', 'nullif(c.display_name')} AS shown,
        round(list_cosine_similarity(e.v, c.centroid_embedding), 9) AS sim
      FROM grp g JOIN fx_label_vectors e ON e.vec_id = g.k JOIN named c ON c.field_name = g.field_name
      WHERE NOT is_true AND {ACTIVE} AND {ANOMALY} AND centroid_embedding IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY g.field_name, g.normalized_label ORDER BY sim DESC, c.cluster_id) = 1""",
    "plan": f"""SELECT g.field_name, g.normalized_label,
        CASE WHEN is_true THEN 'TRUE_ANOMALY' ELSE 'NEW_CLUSTER_CANDIDATE' END AS original_status,
        CASE WHEN n.sim >= 0.88 THEN 'ATTACH_TO_EXISTING_ANOMALY_CLUSTER' WHEN s.cluster_id IS NOT NULL THEN 'MAP_TO_EXISTING_CLUSTER'
          ELSE 'CREATE_OR_UPDATE_INDIVIDUAL_ANOMALY_CLUSTER' END AS action,
        CASE WHEN n.sim >= 0.88 THEN n.cluster_id WHEN s.cluster_id IS NOT NULL THEN s.cluster_id
          ELSE 'weekly_anom_' || left(sha256(g.field_name || '||' || g.normalized_label), 18) END AS target_cluster_id,
        CASE WHEN n.sim >= 0.88 THEN n.shown WHEN s.cluster_id IS NOT NULL THEN s.candidate_name
          ELSE 'Label ' || g.k END AS target_name,
        CASE WHEN n.sim >= 0.88 THEN round(n.sim, 6) WHEN s.cluster_id IS NOT NULL THEN round(s.avg_score, 6)
          ELSE g.avg_similarity END AS similarity, g.row_count
      FROM grp g LEFT JOIN near n ON n.field_name = g.field_name AND n.normalized_label = g.normalized_label
      LEFT JOIN (SELECT s.* FROM safe s SEMI JOIN (SELECT * FROM fx_clusters WHERE NOT {ANOMALY}) c
          ON c.field_name = s.field_name AND c.cluster_id = s.cluster_id
        WHERE close_to_threshold AND stable_top_candidate AND strong_margin AND shares_key_components) s
        ON s.field_name = g.field_name AND s.normalized_label = g.normalized_label AND NOT is_true
      UNION ALL
      SELECT field_name, normalized_label, 'KNOWN_TRUE_ANOMALY', 'REFRESH_KNOWN_ANOMALY_AND_PROMOTE_IF_RECURRING',
        mapped_cluster_id, any_value(mapped_display_name), round(sum(similarity_score::DOUBLE) / count(*), 6), count(*)
      FROM fx_outputs WHERE mapping_status = 'KNOWN_TRUE_ANOMALY' AND normalized_label <> '' AND {in_window('classified_at')}
      GROUP BY field_name, mapped_cluster_id, normalized_label""",
}
_PLAN_TABLES = ("fx_candidates", "fx_clusters", "fx_names", "fx_label_map")


def plan_of(t):
    targets = M.cluster_targets(t.clusters(), t.names())
    return W.resolve_plan(t.outputs_with_candidates(), targets, t.clusters(), START, END)


@query("resolve_plan", "G13 E16", with_tables("SELECT * FROM plan", *_PLAN_TABLES, **PLAN_STEPS))
def _(t):
    return plan_of(t).select(
        "field_name", "normalized_label", "original_status", "action", "target_cluster_id", "target_name",
        F.round("similarity", 6).alias("similarity"), "row_count",
    )


@query(
    "map_to_existing", "G17",
    with_tables(
        """SELECT o.event_id, coalesce(p.target_cluster_id, o.mapped_cluster_id) AS mapped_cluster_id,
          CASE WHEN p.action IS NOT NULL THEN 'EXISTING_CLUSTER' ELSE o.mapping_status END AS mapping_status,
          CASE WHEN p.action IS NOT NULL THEN 'weekly_safe_map_to_existing' ELSE o.mapping_method END AS mapping_method
        FROM fx_outputs o LEFT JOIN plan p ON p.action = 'MAP_TO_EXISTING_CLUSTER' AND p.field_name = o.field_name
          AND p.normalized_label = o.normalized_label AND o.mapping_status = 'NEW_CLUSTER_CANDIDATE'""",
        *_PLAN_TABLES, **PLAN_STEPS,
    ),
)
def _(t):
    _, out = W.map_to_existing(plan_of(t), t.label_map(), t.outputs())
    return out.select("event_id", "mapped_cluster_id", "mapping_status", "mapping_method")


@query(
    "mark_anomaly_outputs", "G18",
    with_tables(
        """SELECT o.event_id, coalesce(p.target_cluster_id, o.mapped_cluster_id) AS mapped_cluster_id,
          CASE WHEN p.action IS NOT NULL THEN 'KNOWN_TRUE_ANOMALY' ELSE o.mapping_status END AS mapping_status,
          CASE WHEN p.action = 'CREATE_OR_UPDATE_INDIVIDUAL_ANOMALY_CLUSTER' THEN 'weekly_created_anomaly_cluster'
            WHEN p.action IS NOT NULL THEN 'weekly_updated_anomaly_cluster' ELSE o.mapping_method END AS mapping_method
        FROM fx_outputs o LEFT JOIN (SELECT * FROM plan WHERE action <> 'MAP_TO_EXISTING_CLUSTER'
          QUALIFY row_number() OVER (PARTITION BY field_name, normalized_label
            ORDER BY original_status = 'KNOWN_TRUE_ANOMALY', target_cluster_id) = 1) p
          ON p.field_name = o.field_name AND p.normalized_label = o.normalized_label
          AND o.mapping_status IN ('TRUE_ANOMALY', 'NEW_CLUSTER_CANDIDATE', 'KNOWN_TRUE_ANOMALY')""",
        *_PLAN_TABLES, **PLAN_STEPS,
    ),
)
def _(t):
    out = W.mark_anomaly_outputs(plan_of(t), t.outputs())
    return out.select("event_id", "mapped_cluster_id", "mapping_status", "mapping_method")


@query(
    "outputs_in_buckets", "G17 G18 A9",
    with_tables(
        """SELECT o.event_id, coalesce(s.target_cluster_id, a.target_cluster_id, o.mapped_cluster_id) AS mapped_cluster_id,
          CASE WHEN s.action IS NOT NULL THEN 'EXISTING_CLUSTER' WHEN a.action IS NOT NULL THEN 'KNOWN_TRUE_ANOMALY' ELSE o.mapping_status END AS mapping_status,
          CASE WHEN s.action IS NOT NULL THEN 'weekly_safe_map_to_existing' WHEN a.action = 'CREATE_OR_UPDATE_INDIVIDUAL_ANOMALY_CLUSTER'
            THEN 'weekly_created_anomaly_cluster' WHEN a.action IS NOT NULL THEN 'weekly_updated_anomaly_cluster' ELSE o.mapping_method END AS mapping_method
        FROM fx_outputs o LEFT JOIN plan s ON s.action = 'MAP_TO_EXISTING_CLUSTER' AND s.field_name = o.field_name
          AND s.normalized_label = o.normalized_label AND o.mapping_status = 'NEW_CLUSTER_CANDIDATE'
        LEFT JOIN (SELECT * FROM plan WHERE action <> 'MAP_TO_EXISTING_CLUSTER'
          QUALIFY row_number() OVER (PARTITION BY field_name, normalized_label
            ORDER BY original_status = 'KNOWN_TRUE_ANOMALY', target_cluster_id) = 1) a
          ON a.field_name = o.field_name AND a.normalized_label = o.normalized_label AND s.action IS NULL
          AND o.mapping_status IN ('TRUE_ANOMALY', 'NEW_CLUSTER_CANDIDATE', 'KNOWN_TRUE_ANOMALY')""",
        *_PLAN_TABLES, **PLAN_STEPS,
    ),
)
def _(t):
    """Both changes of the week, in a stored table of which only the planned labels' buckets are rewritten."""
    table = KeyedTable(t.spark, f"{checkpoint_dir(t.spark)}/outputs-{uuid.uuid4().hex}", ["event_id"], buckets=32, by=W.GROUP)
    table.create(t.outputs())
    maintenance.apply_to_outputs(plan_of(t), t.label_map(), table)
    return table.read().select("event_id", "mapped_cluster_id", "mapping_status", "mapping_method")


ANOMALY_STEPS = PLAN_STEPS | {
    "p": """SELECT * FROM plan WHERE action <> 'MAP_TO_EXISTING_CLUSTER'""",
    "tgt": "SELECT DISTINCT field_name, target_cluster_id FROM p",
    "old_labels": """SELECT m.field_name, m.final_cluster_id AS target_cluster_id, m.raw_label, m.value_count AS c
      FROM fx_label_map m SEMI JOIN tgt ON tgt.field_name = m.field_name AND tgt.target_cluster_id = m.final_cluster_id""",
    "label_counts": """SELECT field_name, target_cluster_id, raw_label, sum(c) AS c FROM (
        SELECT * FROM old_labels UNION ALL
        SELECT field_name, target_cluster_id, 'Label_' || split_part(normalized_label, ' ', 2), row_count * row_count FROM p) GROUP BY ALL""",
    "sizes": """SELECT field_name, target_cluster_id, cast(count(*) AS INT) AS cluster_size, cast(sum(c) AS BIGINT) AS total_occurrences,
        array_to_string(list(raw_label ORDER BY c DESC, raw_label)[1:10], ',') AS reps FROM label_counts GROUP BY ALL""",
    "one": """SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY field_name, normalized_label
        ORDER BY original_status = 'KNOWN_TRUE_ANOMALY', target_cluster_id) = 1""",
    "new_map": """SELECT m.field_name, m.normalized_label, coalesce(o.target_cluster_id, m.final_cluster_id) AS cluster_id,
          coalesce(o.row_count, m.value_count) AS value_count FROM fx_label_map m LEFT JOIN one o USING (field_name, normalized_label)
        UNION ALL SELECT field_name, normalized_label, target_cluster_id, row_count FROM one
          ANTI JOIN fx_label_map m USING (field_name, normalized_label)""",
    "new_counters": """SELECT o.field_name, l.cluster_id, count(*) AS row_count, count(DISTINCT source_record_id) AS calls,
        count(DISTINCT date_trunc('week', classified_at)) AS weeks, max(s) AS label_sum
      FROM fx_outputs o JOIN (SELECT field_name, normalized_label, cluster_id, sum(value_count) AS s FROM new_map GROUP BY ALL) l
        USING (field_name, normalized_label) GROUP BY ALL""",
    "heads": """SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY field_name, target_cluster_id
        ORDER BY row_count DESC, normalized_label) = 1""",
}


@query(
    "upsert_anomaly_clusters", "G14",
    with_tables(
        """SELECT h.field_name, h.target_cluster_id AS cluster_id, h.target_name AS display_name, s.cluster_size,
          s.total_occurrences, s.reps,
          CASE WHEN n.calls >= 10 OR greatest(n.row_count, n.label_sum) >= 25 OR n.weeks >= 2
            THEN 'STANDARD_CLUSTER_PROMOTION_CANDIDATE' ELSE 'ACTIVE_TRUE_ANOMALY' END AS promotion_status
        FROM heads h JOIN sizes s USING (field_name, target_cluster_id)
        LEFT JOIN new_counters n ON n.field_name = h.field_name AND n.cluster_id = h.target_cluster_id""",
        *_PLAN_TABLES, **ANOMALY_STEPS,
    ),
)
def _(t):
    plan = plan_of(t)
    clusters = t.clusters().withColumn("representative_labels", F.lit(None).cast("array<string>"))
    state = W.State(clusters, t.names(), t.label_map(), t.outputs_with_candidates(), t.label_embeddings())
    new = W.upsert_anomaly_clusters(plan, state, START, END)
    touched = plan.filter("action <> 'MAP_TO_EXISTING_CLUSTER'").select(
        "field_name", F.col("target_cluster_id").alias("cluster_id")).distinct()
    return new.clusters.join(touched, ["field_name", "cluster_id"], "left_semi").select(
        "field_name", "cluster_id", "display_name", "cluster_size", "total_occurrences",
        F.array_join("representative_labels", ",").alias("reps"), "promotion_status",
    )


PROMOTE_STEPS = {
    "named": NAMED, "sn": STANDARD_NAMES,
    "cand": f"""SELECT field_name, cluster_id, resolved, {X.name_key('resolved')} AS k FROM (
      SELECT field_name, cluster_id, {X.sanitize(SHOWN, ACRONYMS_WEEKLY)} AS resolved FROM named
      WHERE coalesce(is_true_anomaly_cluster, false))""",
    "won": f"""SELECT field_name, cluster_id, CASE WHEN NOT blocked AND row_number() OVER (PARTITION BY field_name, k
        ORDER BY cluster_id) = 1 THEN resolved END AS standard_name FROM (
      SELECT *, EXISTS (SELECT 1 FROM sn WHERE sn.field_name = p.field_name AND sn.cluster_id <> p.cluster_id
        AND {X.name_key('sn.display_name')} = k) AS blocked FROM cand p)""",
}


def promoted(t):
    c = M.with_names(t.clusters(), t.names()).filter("is_true_anomaly_cluster").select(
        "field_name", "cluster_id", M.shown_name().alias("proposed"), F.col("medoid_label").alias("representative")
    )
    return W.promote(W.State(t.clusters(), t.names(), t.label_map(), t.outputs()), c)[0]


@query(
    "promote_clusters", "G15",
    with_tables(
        """SELECT c.id, CASE WHEN w.standard_name IS NOT NULL THEN false ELSE c.is_true_anomaly_cluster END AS is_true_anomaly_cluster,
          coalesce(w.standard_name, c.display_name) AS display_name,
          CASE WHEN w.standard_name IS NOT NULL THEN 'PROMOTED_TO_STANDARD'
            WHEN w.cluster_id IS NOT NULL THEN 'STANDARD_CLUSTER_PROMOTION_BLOCKED_DUPLICATE_NAME' ELSE promotion_status END AS promotion_status
        FROM fx_clusters c LEFT JOIN won w ON w.field_name = c.field_name AND w.cluster_id = c.cluster_id""",
        "fx_clusters", "fx_names", **PROMOTE_STEPS,
    ),
)
def _(t):
    return promoted(t).clusters.select("id", "is_true_anomaly_cluster", "display_name", "promotion_status")


@query(
    "promote_outputs", "G15",
    with_tables(
        """SELECT o.event_id, CASE WHEN w.standard_name IS NOT NULL THEN 'EXISTING_CLUSTER' ELSE o.mapping_status END AS mapping_status,
          coalesce(w.standard_name, o.mapped_display_name) AS mapped_display_name
        FROM fx_outputs o LEFT JOIN won w ON w.field_name = o.field_name AND w.cluster_id = o.mapped_cluster_id
          AND o.mapping_status = 'KNOWN_TRUE_ANOMALY'""",
        "fx_outputs", "fx_clusters", "fx_names", **PROMOTE_STEPS,
    ),
)
def _(t):
    return promoted(t).outputs.select("event_id", "mapping_status", "mapped_display_name")
