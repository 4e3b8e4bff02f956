"""Queries over the mapper: exact maps, ranking, statuses, semantic matches."""

from pyspark.sql import functions as F

from ..operators import mapping as M
from ..oracles.fixtures import with_tables
from ..registry import query

ACTIVE = "coalesce(active, true)"
ANOMALY = "coalesce(is_true_anomaly_cluster, false)"


@query(
    "active_clusters", "B1",
    with_tables(
        f"""SELECT id, field_name, cluster_id FROM fx_clusters WHERE {ACTIVE} AND NOT {ANOMALY}
        AND field_name IN ('field_0', 'field_1') AND coalesce(cluster_version, 'v1') = 'v1'
        AND centroid_embedding IS NOT NULL""",
        "fx_clusters",
    ),
)
def _(t):
    df = M.active_clusters(t.clusters(), ["field_0", "field_1"], anomaly=False, version="v1")
    return df.select("id", "field_name", "cluster_id")


@query(
    "cluster_thresholds", "B6",
    with_tables(
        "SELECT id, CASE WHEN field_name = 'field_1' THEN 0.9::DOUBLE ELSE coalesce(similarity_threshold, 0.82) END AS threshold FROM fx_clusters",
        "fx_clusters",
    ),
)
def _(t):
    return M.with_thresholds(t.clusters(), {"field_1": 0.9}).select("id", "threshold")


NAMED = """SELECT c.*, n.display_name AS name, n.naming_method FROM fx_clusters c LEFT JOIN fx_names n
  ON n.field_name = c.field_name AND n.cluster_id = c.cluster_id
  AND (n.run_id = c.run_id OR n.run_id IS NULL OR c.run_id IS NULL)
  AND (n.cluster_version = c.cluster_version OR n.cluster_version IS NULL OR c.cluster_version IS NULL)"""
SHOWN = "coalesce(nullif(name, ''), nullif(display_name, ''), cluster_id)"


@query(
    "with_names_tolerant", "E4",
    with_tables(f"SELECT id, name, {SHOWN} AS shown FROM named", "fx_clusters", "fx_names", named=NAMED),
)
def _(t):
    return M.with_names(t.clusters(), t.names()).select("id", "name", M.shown_name().alias("shown"))


@query(
    "with_names_strict", "E4",
    with_tables(
        """SELECT c.id, n.display_name AS name FROM fx_clusters c LEFT JOIN fx_names n
        USING (field_name, cluster_id, run_id, cluster_version)""",
        "fx_clusters", "fx_names",
    ),
)
def _(t):
    return M.with_names(t.clusters(), t.names(), "strict").select("id", "name")


@query(
    "with_names_fan_out", "E4",
    with_tables(
        """SELECT c.id, n.display_name AS name, n.run_id AS _r FROM fx_clusters c LEFT JOIN both_names n
        ON n.field_name = c.field_name AND n.cluster_id = c.cluster_id
        AND (n.run_id = c.run_id OR n.run_id IS NULL)
        AND (n.cluster_version = c.cluster_version OR n.cluster_version IS NULL OR c.cluster_version IS NULL)""",
        "fx_clusters", "fx_names",
        both_names="""SELECT field_name, cluster_id, run_id, cluster_version, display_name FROM fx_names
          UNION ALL SELECT field_name, cluster_id, NULL, NULL, display_name || ' old' FROM fx_names""",
    ).replace(", n.run_id AS _r", ""),
)
def _(t):
    names = t.names()
    old = names.withColumns(
        {
            "run_id": F.lit(None).cast("string"), "cluster_version": F.lit(None).cast("string"),
            "display_name": F.concat("display_name", F.lit(" old")),
        }
    )
    return M.with_names(t.clusters(), names.unionByName(old), keep_all=True).select("id", "name")


def exact_steps():
    out = {"named": NAMED}
    for tag, test in (("std", f"NOT {ANOMALY}"), ("anom", ANOMALY)):
        out[f"exact_{tag}"] = f"""
          SELECT m.field_name, m.normalized_label, c.cluster_id, {SHOWN.replace('name,', 'c.name,', 1).replace('nullif(display_name', 'nullif(c.display_name').replace(', cluster_id', ', c.cluster_id')} AS display_name,
            coalesce(m.cluster_version, 'v1') AS cluster_version
          FROM fx_label_map m JOIN named c ON c.field_name = m.field_name AND c.cluster_id = m.final_cluster_id
            AND coalesce(c.cluster_version, 'v1') = coalesce(m.cluster_version, 'v1')
          WHERE {ACTIVE.replace('active', 'c.active')} AND {test.replace('is_true', 'c.is_true')}
          QUALIFY row_number() OVER (PARTITION BY m.field_name, m.normalized_label
            ORDER BY m.value_count DESC, c.cluster_id, m.run_id) = 1"""
    return out


for _anom, _tag in ((False, "std"), (True, "anom")):

    def _build(t, anomaly=_anom):
        out = M.load_exact_map(t.label_map(), t.clusters(), t.names(), anomaly)
        return out.drop("is_anomaly")

    query(
        f"exact_map_{_tag}", "E3",
        with_tables(f"SELECT * FROM exact_{_tag}", "fx_label_map", "fx_clusters", "fx_names", **exact_steps()),
    )(_build)


def exact_matched(t):
    state = (t.label_map(), t.clusters(), t.names())
    std, anom = (M.load_exact_map(*state, anomaly=a) for a in (False, True))
    return M.exact_map_join(t.outputs().filter("normalized_label <> ''"), std, anom)


@query(
    "exact_map_join", "E2 G3",
    with_tables(
        """SELECT o.event_id, coalesce(s.cluster_id, a.cluster_id) AS mapped_cluster_id,
          CASE WHEN s.cluster_id IS NOT NULL THEN 'EXISTING_CLUSTER' ELSE 'KNOWN_TRUE_ANOMALY' END AS mapping_status,
          CASE WHEN s.cluster_id IS NOT NULL THEN 'exact_label_map' ELSE 'exact_anomaly_label_map' END AS mapping_method,
          coalesce(s.display_name, a.display_name) AS mapped_display_name, 1.0::DOUBLE AS similarity_score
        FROM fx_outputs o LEFT JOIN exact_std s USING (field_name, normalized_label)
        LEFT JOIN exact_anom a USING (field_name, normalized_label)
        WHERE normalized_label <> '' AND (s.cluster_id IS NOT NULL OR a.cluster_id IS NOT NULL)""",
        "fx_outputs", "fx_label_map", "fx_clusters", "fx_names", **exact_steps(),
    ),
)
def _(t):
    hit = exact_matched(t).filter("exact_cluster_id IS NOT NULL")
    return M.exact_status(hit).select(
        "event_id", "mapped_cluster_id", "mapping_status", "mapping_method", "mapped_display_name",
        "similarity_score",
    )


# Label and cluster texts with actors and opposites, so that the guards have work.
def guard_labels(t):
    i = F.col("vec_id")
    raw = F.when(i % 2 == 0, "Agent_Yelled_At_Customer_").otherwise("Call_Received_")
    return t.label_vectors().select(
        "field_name", F.col("raw_label").alias("label_id"), "vec_id",
        F.concat(raw, i.cast("string")).alias("raw_label"), "normalized_label",
        F.col("v").alias("embedding"),
    )


def guard_clusters(t):
    i = F.col("id")
    text = (
        F.when(i % 3 == 0, "Customer_Insulted_Agent").when(i % 3 == 1, "not received")
        .otherwise(F.col("medoid_label"))
    )
    return t.clusters().withColumn("medoid_label", text)


GUARD_STEPS = {
    "named": NAMED,
    "targets": f"""SELECT id, field_name, cluster_id, coalesce(cluster_version, 'v1') AS cluster_version, {SHOWN} AS shown,
      {ANOMALY} AS anom, coalesce(similarity_threshold, 0.82::DOUBLE) AS threshold, centroid_embedding AS c
      FROM named WHERE {ACTIVE} AND centroid_embedding IS NOT NULL""",
    "pairs": """SELECT l.vec_id, l.field_name, l.raw_label AS label_id, t.*,
        round(list_inner_product(l.v, t.c), 9) AS sim, l.vec_id % 2 = 0 AND t.id % 3 = 0 AS conflict,
        l.vec_id % 2 = 1 AND t.id % 3 = 1 AS contra
      FROM fx_label_vectors l JOIN targets t USING (field_name)""",
    "ranks": """SELECT *, row_number() OVER (PARTITION BY vec_id, anom ORDER BY sim DESC, cluster_id) AS rank,
      row_number() OVER (PARTITION BY vec_id, anom ORDER BY conflict, sim DESC, cluster_id) = 1 AND NOT conflict AS ok_first
      FROM pairs""",
}


@query(
    "rank_candidates", "E5",
    with_tables(
        """SELECT label_id, cluster_id, CASE WHEN anom THEN 'anomaly' ELSE 'standard' END AS source,
          round(sim, 6) AS similarity, cast(rank AS INT) AS rank, conflict AS actor_conflict, ok_first
        FROM ranks WHERE rank <= 3 OR ok_first""",
        "fx_label_vectors", "fx_clusters", "fx_names", **GUARD_STEPS,
    ),
)
def _(t):
    targets = M.cluster_targets(guard_clusters(t), t.names())
    out = M.rank_candidates(guard_labels(t), targets, k=3)
    return out.select(
        "label_id", "cluster_id", "source", F.round("similarity", 6).alias("similarity"), "rank",
        "actor_conflict", "ok_first",
    )


STATUS_STEPS = GUARD_STEPS | {
    "best": """SELECT l.vec_id, l.field_name, l.raw_label AS label_id,
        max(sim) FILTER (ok_first AND NOT anom) AS s_sim, max(sim) FILTER (ok_first AND anom) AS a_sim,
        arg_max(cluster_id, sim) FILTER (ok_first AND NOT anom) AS s_id, arg_max(cluster_id, sim) FILTER (ok_first AND anom) AS a_id,
        arg_max(threshold, sim) FILTER (ok_first AND NOT anom) AS s_t,
        arg_max(shown, sim) FILTER (ok_first AND NOT anom) AS s_name, arg_max(shown, sim) FILTER (ok_first AND anom) AS a_name,
        string_agg(cluster_id, ',' ORDER BY rank) FILTER (rank <= 5 AND NOT anom) AS s_list,
        string_agg(cluster_id, ',' ORDER BY rank) FILTER (rank <= 5 AND anom) AS a_list
      FROM (SELECT vec_id, field_name, raw_label FROM fx_label_vectors) l JOIN (SELECT * EXCLUDE (field_name, label_id) FROM ranks) r USING (vec_id) GROUP BY ALL""",
    "statuses": """SELECT *, CASE WHEN s_sim >= s_t THEN 'EXISTING_CLUSTER' WHEN a_sim >= 0.88 THEN 'KNOWN_TRUE_ANOMALY'
        WHEN s_sim >= 0.72 THEN 'NEW_CLUSTER_CANDIDATE' ELSE 'TRUE_ANOMALY' END AS mapping_status FROM best""",
}


def status_rows(t):
    targets = M.cluster_targets(guard_clusters(t), t.names())
    labels = guard_labels(t)
    return M.mapping_status(labels, M.rank_candidates(labels, targets), targets)


@query(
    "mapping_status", "G3 E5 A16",
    with_tables(
        """SELECT label_id, mapping_status,
          CASE mapping_status WHEN 'EXISTING_CLUSTER' THEN 'centroid_similarity' WHEN 'KNOWN_TRUE_ANOMALY' THEN 'anomaly_centroid_similarity'
            WHEN 'NEW_CLUSTER_CANDIDATE' THEN 'near_existing_below_threshold' ELSE 'low_similarity_unresolved' END AS mapping_method,
          CASE mapping_status WHEN 'EXISTING_CLUSTER' THEN s_id WHEN 'KNOWN_TRUE_ANOMALY' THEN a_id END AS mapped_cluster_id,
          CASE mapping_status WHEN 'EXISTING_CLUSTER' THEN s_name WHEN 'KNOWN_TRUE_ANOMALY' THEN a_name END AS mapped_display_name,
          round(CASE mapping_status WHEN 'KNOWN_TRUE_ANOMALY' THEN a_sim ELSE coalesce(s_sim, a_sim) END, 6) AS similarity_score,
          CASE mapping_status WHEN 'KNOWN_TRUE_ANOMALY' THEN 0.88::DOUBLE ELSE coalesce(s_t, CASE WHEN a_sim IS NOT NULL THEN 0.88::DOUBLE END) END
            AS existing_cluster_threshold,
          CASE mapping_status WHEN 'EXISTING_CLUSTER' THEN s_list WHEN 'KNOWN_TRUE_ANOMALY' THEN concat_ws(',', a_list, s_list)
            ELSE concat_ws(',', s_list, a_list) END AS candidates
        FROM statuses""",
        "fx_label_vectors", "fx_clusters", "fx_names", **STATUS_STEPS,
    ),
)
def _(t):
    return status_rows(t).select(
        "label_id", "mapping_status", "mapping_method", "mapped_cluster_id", "mapped_display_name",
        F.round("similarity_score", 6).alias("similarity_score"), "existing_cluster_threshold",
        F.array_join("top_candidates.cluster_id", ",").alias("candidates"),
    )


@query(
    "mapping_status_per_field", "G5",
    with_tables(
        "SELECT field_name, mapping_status, count(*) AS n_rows FROM statuses GROUP BY ALL",
        "fx_label_vectors", "fx_clusters", "fx_names", **STATUS_STEPS,
    ),
)
def _(t):
    out = M.mapping_summary(status_rows(t))
    return out.groupBy("field_name", "mapping_status").agg(F.sum("n_rows").alias("n_rows"))


@query(
    "mapping_summary", "G5",
    with_tables(
        "SELECT field_name, mapping_status, mapping_method, count(*) AS n_rows FROM fx_outputs GROUP BY ALL",
        "fx_outputs",
    ),
)
def _(t):
    return M.mapping_summary(t.outputs())


@query(
    "status_counts", "G5",
    with_tables(
        """SELECT field_name, string_agg(mapping_status || '=' || n, ',' ORDER BY mapping_status) AS counts
        FROM (SELECT field_name, mapping_status, count(*) AS n FROM fx_outputs GROUP BY ALL) GROUP BY field_name""",
        "fx_outputs",
    ),
)
def _(t):
    pairs = F.transform(
        F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return M.status_counts(t.outputs()).select("field_name", F.array_join(pairs, ",").alias("counts"))


@query(
    "semantic_match", "E6",
    with_tables(
        """SELECT label_id, reason, CASE WHEN reason = 'accepted_semantic_match' THEN cluster_id END AS match_cluster_id,
          round(sim, 6) AS best_similarity, round(second, 6) AS second_similarity, top FROM (
          SELECT *, CASE WHEN sim < 0.82 THEN 'best_similarity_below_threshold'
            WHEN round(sim - second, 9) < 0.015 THEN 'semantic_top_candidate_not_stable'
            WHEN conflict THEN 'actor_direction_conflict' WHEN contra THEN 'contradiction_guard_blocked'
            ELSE 'accepted_semantic_match' END AS reason
          FROM (SELECT *, lead(sim) OVER w AS second, row_number() OVER w AS rn,
              array_to_string(list(cluster_id) OVER (PARTITION BY vec_id ORDER BY sim DESC, cluster_id
                ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), ',') AS top
            FROM pairs WINDOW w AS (PARTITION BY vec_id ORDER BY sim DESC, cluster_id)) WHERE rn = 1)""",
        "fx_label_vectors", "fx_clusters", "fx_names", **GUARD_STEPS,
    ),
)
def _(t):
    targets = M.cluster_targets(guard_clusters(t), t.names())
    return M.semantic_match(guard_labels(t), targets).select(
        "label_id", "reason", "match_cluster_id", F.round("best_similarity", 6).alias("best_similarity"),
        F.round("second_similarity", 6).alias("second_similarity"),
        F.array_join("top_candidates.cluster_id", ",").alias("top"),
    )
