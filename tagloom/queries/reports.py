"""Queries over the taxonomy state: lists, health, naming, anomalies, quality."""

from pyspark.sql import functions as F

from ..functions.lists import GENERIC_NAMES, WEAK_MEDOIDS
from ..operators import reports as R
from ..oracles import expr as X
from ..oracles.fixtures import with_tables
from ..registry import query
from .mapping import ANOMALY
from .text_jobs import ANOMALY_TYPE, SIZE_BUCKET

TS = "yyyy-MM-dd HH:mm:ss"


def ts_sql(c):
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def ts(df, *cols):
    return df.withColumns({c: F.date_format(c, TS) for c in cols})


def state(t):
    return t.clusters(), t.names(), t.label_map()


STRICT = """SELECT c.*, n.display_name AS name, coalesce(n.display_name, c.display_name) AS shown
  FROM fx_clusters c LEFT JOIN fx_names n USING (field_name, cluster_id, run_id, cluster_version)"""
LABELS = """SELECT field_name, run_id, final_cluster_id AS cluster_id, count(DISTINCT raw_label) AS label_count
  FROM fx_label_map GROUP BY ALL"""
SPOTS = """SELECT * FROM fx_coordinates QUALIFY row_number() OVER (PARTITION BY field_name, cluster_id, projection_method
  ORDER BY created_at DESC, run_id) = 1"""
STATE = ("fx_clusters", "fx_names", "fx_label_map")


def reg(name, covers, sql, *tables, **steps):
    """Register with a SQL check; an empty text means a rows-only check."""
    return query(name, covers, with_tables(sql, *tables, **steps) if sql else None)


@reg("label_counts", "B5", "SELECT * FROM labels_per", "fx_label_map", labels_per=LABELS)
def _(t):
    return R.label_counts(t.label_map())


@reg(
    "cluster_list", "B2 E19",
    """SELECT id, field_name, cluster_id, shown, label_count, round(x, 6) AS projection_x FROM (
      SELECT s.*, coalesce(l.label_count, 0) AS label_count, p.x FROM strict s
      LEFT JOIN labels_per l USING (field_name, run_id, cluster_id)
      LEFT JOIN (SELECT * FROM spots WHERE projection_method = 'pca') p USING (field_name, cluster_id))
    ORDER BY coalesce(is_true_anomaly_cluster, false), coalesce(cluster_size, 0) DESC, field_name, cluster_id, id
    LIMIT 12 OFFSET 3""",
    *STATE, "fx_coordinates", strict=STRICT, labels_per=LABELS, spots=SPOTS,
)
def _(t):
    out = R.cluster_list(*state(t), t.coordinates(), limit=12, offset=3)
    return out.select("id", "field_name", "cluster_id", "shown", "label_count", F.round("projection_x", 6).alias("projection_x"))


@reg(
    "cluster_search", "B2",
    f"""SELECT id, shown FROM strict s WHERE NOT {ANOMALY} AND cluster_size >= 2 AND (cluster_id ILIKE '%_1%' OR medoid_label ILIKE '%_1%'
      OR name ILIKE '%_1%' OR EXISTS (SELECT 1 FROM fx_label_map m WHERE m.final_cluster_id = s.cluster_id AND m.field_name = s.field_name
        AND m.run_id = s.run_id AND (m.raw_label ILIKE '%_1%' OR m.normalized_label ILIKE '%_1%')))""",
    *STATE, strict=STRICT,
)
def _(t):
    return R.cluster_list(*state(t), anomaly=False, search="_1", min_size=2, limit=50000).select("id", "shown")


@reg(
    "clusters_by_display", "B8",
    f"""SELECT id FROM fx_clusters WHERE field_name IN ('field_0', 'field_2') AND NOT {ANOMALY} AND cluster_size >= 5""",
    "fx_clusters",
)
def _(t):
    return R.clusters_by_display(t.clusters(), ["field_0", "field_2"], False, 5).select("id")


@reg(
    "health", "H1",
    f"""SELECT count(*) AS total_clusters, count(n.cluster_id) AS named_clusters, count(*) - count(n.cluster_id) AS unnamed_clusters,
      count(*) FILTER ({ANOMALY}) AS anomaly_clusters, count(*) FILTER (NOT {ANOMALY}) AS standard_clusters,
      count(DISTINCT c.field_name) AS fields_count, count(*) FILTER (centroid_embedding IS NULL) AS centroid_missing_count,
      (SELECT count(*) FROM fx_label_map) AS total_label_rows,
      (SELECT count(*) FROM (SELECT 1 FROM fx_names GROUP BY field_name, run_id, cluster_version, display_name HAVING count(*) > 1)) AS duplicate_names,
      (SELECT count(*) FROM fx_cluster_runs) AS last_run_count
    FROM fx_clusters c LEFT JOIN fx_names n ON n.field_name = c.field_name AND n.cluster_id = c.cluster_id
      AND n.run_id = c.run_id AND n.cluster_version = c.cluster_version""",
    *STATE, "fx_cluster_runs",
)
def _(t):
    return R.health(*state(t), t.cluster_runs())


@reg(
    "projection_stats", "H2",
    f"""SELECT projection_method, count(*) AS row_count, count(DISTINCT field_name || '::' || cluster_id) AS unique_clusters,
      round(min(x), 4) AS x_min, round(max(x), 4) AS x_max, round(min(y), 4) AS y_min, round(max(y), 4) AS y_max,
      {ts_sql('max(created_at)')} AS latest_run FROM fx_coordinates GROUP BY projection_method""",
    "fx_coordinates",
)
def _(t):
    return ts(R.projection_stats(t.coordinates()), "latest_run")


@reg("latest_projection", "E19",
     "SELECT field_name, cluster_id, projection_method, run_id, round(x, 6) AS x, round(z, 6) AS z FROM spots",
     "fx_coordinates", spots=SPOTS)
def _(t):
    return R.latest_projection(t.coordinates()).select(
        "field_name", "cluster_id", "projection_method", "run_id", F.round("x", 6).alias("x"), F.round("z", 6).alias("z")
    )


@reg("fields", "H3", "SELECT DISTINCT field_name FROM fx_clusters", "fx_clusters")
def _(t):
    return R.fields(t.clusters())


@reg(
    "cluster_detail", "H4 E20",
    """SELECT c.id, c.cluster_id, coalesce(n.display_name, c.display_name) AS shown, f.n AS final_cluster_count,
      'latest_field_metadata' AS metadata_source
    FROM fx_clusters c LEFT JOIN fx_names n USING (field_name, cluster_id, run_id, cluster_version)
    JOIN (SELECT field_name, run_id, count(*) AS n FROM fx_clusters GROUP BY ALL) f USING (field_name, run_id) WHERE c.id = 7""",
    *STATE,
)
def _(t):
    out = R.cluster_detail(t.clusters(), t.names(), t.cluster_runs(), 7)
    return out.select("id", "cluster_id", "shown", "final_cluster_count", "metadata_source")


@reg(
    "cluster_labels", "H4",
    """SELECT m.raw_label, m.normalized_label, m.value_count, m.final_is_true_anomaly FROM fx_label_map m
    JOIN fx_clusters c ON c.field_name = m.field_name AND c.run_id = m.run_id AND c.cluster_id = m.final_cluster_id
    WHERE c.id = 7 ORDER BY m.value_count DESC, m.raw_label LIMIT 10""",
    *STATE,
)
def _(t):
    return R.cluster_labels(t.clusters(), t.label_map(), 7, 10)


@reg(
    "latest_metadata", "E20",
    """SELECT o.run_id, o.field_name, CASE WHEN a.run_id IS NOT NULL THEN 'exact_run_and_field' WHEN b.run_id IS NOT NULL THEN 'exact_run'
        WHEN c.field_name IS NOT NULL THEN 'latest_field_metadata' ELSE 'computed_from_clusters' END AS metadata_source,
      CASE WHEN coalesce(a.run_id, b.run_id, c.run_id) IS NOT NULL THEN 'hash-384' END AS model_name,
      coalesce(r.labels, f.labels, CASE WHEN a.run_id IS NOT NULL THEN a.n_total WHEN b.run_id IS NOT NULL THEN b.n_total ELSE c.n_total END) AS total_labels,
      coalesce(r.n, f.n) AS final_cluster_count
    FROM wanted o LEFT JOIN fx_cluster_runs a ON a.run_id = o.run_id AND a.field_name = o.field_name
    LEFT JOIN fx_cluster_runs b ON b.run_id = o.run_id
    LEFT JOIN (SELECT * FROM fx_cluster_runs QUALIFY row_number() OVER (PARTITION BY field_name ORDER BY created_at DESC, run_id DESC) = 1) c
      ON c.field_name = o.field_name
    LEFT JOIN (SELECT field_name, run_id, count(*) AS n, cast(sum(cluster_size) AS BIGINT) AS labels FROM fx_clusters GROUP BY ALL) r
      ON r.field_name = o.field_name AND r.run_id = o.run_id
    LEFT JOIN (SELECT field_name, count(*) AS n, cast(sum(cluster_size) AS BIGINT) AS labels FROM fx_clusters GROUP BY ALL) f ON f.field_name = o.field_name""",
    "fx_clusters", "fx_cluster_runs",
    wanted="""SELECT run_id, field_name FROM fx_cluster_runs UNION ALL SELECT run_id, 'field_x' FROM fx_cluster_runs
      UNION ALL SELECT DISTINCT run_id, field_name FROM fx_clusters UNION ALL SELECT DISTINCT run_id || '_x', 'field_y' FROM fx_clusters""",
)
def _(t):
    runs, clusters = t.cluster_runs(), t.clusters()
    own = clusters.select("run_id", "field_name").distinct()
    wanted = (
        runs.select("run_id", "field_name").unionByName(runs.select("run_id", F.lit("field_x").alias("field_name")))
        .unionByName(own)
        .unionByName(own.select(F.concat("run_id", F.lit("_x")).alias("run_id"), F.lit("field_y").alias("field_name")))
    )
    return R.latest_metadata(wanted, runs, clusters).select(
        "run_id", "field_name", "metadata_source", "model_name", "total_labels", "final_cluster_count"
    )


@reg(
    "field_distribution", "H5",
    f"""SELECT field_name, count(*) AS total, count(*) FILTER ({ANOMALY}) AS anomalies, cast(sum(cluster_size) AS BIGINT) AS total_labels
    FROM fx_clusters GROUP BY field_name""",
    "fx_clusters",
)
def _(t):
    return R.field_distribution(t.clusters())


@reg("size_distribution", "H6",
     f"SELECT {SIZE_BUCKET} AS bucket, count(*) AS n, min(cluster_size) AS bucket_min FROM fx_clusters GROUP BY 1", "fx_clusters")
def _(t):
    return R.size_distribution(t.clusters())


@reg(
    "anomaly_clusters", "H7",
    f"""SELECT s.id, s.shown, coalesce(l.label_count, 0) AS label_count, {ANOMALY_TYPE} AS anomaly_type FROM strict s
    LEFT JOIN labels_per l USING (field_name, run_id, cluster_id) WHERE {ANOMALY} ORDER BY cluster_size DESC, id LIMIT 500""",
    *STATE, strict=STRICT, labels_per=LABELS,
)
def _(t):
    return R.anomaly_clusters(*state(t)).select("id", "shown", "label_count", "anomaly_type")


@reg(
    "anomaly_by_field", "H7",
    f"""SELECT field_name, count(*) AS anomaly_clusters, cast(sum(cluster_size) AS BIGINT) AS anomaly_labels,
      cast(sum(total_occurrences) AS BIGINT) AS anomaly_occurrences FROM fx_clusters WHERE {ANOMALY} GROUP BY field_name""",
    "fx_clusters",
)
def _(t):
    return R.anomaly_by_field(t.clusters())


@reg(
    "anomaly_totals", "H7",
    f"""SELECT count(*) AS total_clusters, count(*) FILTER (a) AS anomaly_clusters, cast(coalesce(sum(cluster_size) FILTER (a), 0) AS BIGINT) AS anomaly_labels,
      cast(coalesce(sum(total_occurrences) FILTER (a), 0) AS BIGINT) AS anomaly_occurrences,
      count(*) FILTER (a AND k = 'noise') AS noise, count(*) FILTER (a AND k = 'threshold_failure') AS threshold_failure,
      count(*) FILTER (a AND k = 'semantic_outlier') AS semantic_outlier, count(*) FILTER (a AND k = 'emerging') AS emerging,
      round(count(*) FILTER (a) / count(*), 6) AS anomaly_rate
    FROM (SELECT *, {ANOMALY} AS a, {ANOMALY_TYPE} AS k FROM fx_clusters)""",
    "fx_clusters",
)
def _(t):
    return R.anomaly_totals(t.clusters())


@reg(
    "run_timeline", "H8",
    """SELECT strftime(created_at, '%Y-%m-%d') AS run_date, field_name, count(*) AS run_count FROM fx_cluster_runs
    GROUP BY 1, 2 ORDER BY run_date DESC, field_name LIMIT 90""",
    "fx_cluster_runs",
)
def _(t):
    return R.run_timeline(t.cluster_runs())


@reg("newest_clusters", "H8", "SELECT id, shown, cluster_size FROM strict ORDER BY created_at DESC, id LIMIT 20",
     "fx_clusters", "fx_names", strict=STRICT)
def _(t):
    return R.newest_clusters(t.clusters(), t.names()).select("id", "shown", "cluster_size")


@reg(
    "field_stats", "H8",
    f"""SELECT field_name, count(*) AS total_clusters, cast(sum(cluster_size) AS BIGINT) AS total_labels,
      {ts_sql('max(created_at)')} AS last_updated FROM fx_clusters GROUP BY field_name""",
    "fx_clusters",
)
def _(t):
    return ts(R.field_stats(t.clusters()), "last_updated")


NODES = f"""SELECT id, coalesce(shown, cluster_id) AS label, field_name, cluster_id,
  greatest(1.0, round(sqrt(cluster_size) * 0.9, 6)) AS val, {ANOMALY} AS is_anomaly FROM strict
  ORDER BY field_name, cluster_size DESC, id LIMIT 25"""


@reg("semantic_graph_nodes", "H9", "SELECT * FROM nodes", "fx_clusters", "fx_names", strict=STRICT, nodes=NODES)
def _(t):
    return R.graph_nodes(t.clusters(), t.names(), limit=25).withColumn("val", F.round("val", 6)).drop("cluster_size")


@reg(
    "semantic_graph_links", "H9",
    """SELECT DISTINCT least(a.id, b.id) AS source, greatest(a.id, b.id) AS target
    FROM (SELECT DISTINCT field_name, 'base_' || (value_count % 10) AS src, final_cluster_id AS tgt FROM fx_label_map) m
    JOIN nodes a ON a.field_name = m.field_name AND a.cluster_id = m.src
    JOIN nodes b ON b.field_name = m.field_name AND b.cluster_id = m.tgt WHERE a.id <> b.id""",
    *STATE, strict=STRICT, nodes=NODES,
)
def _(t):
    prefixed = t.label_map().withColumn(
        "base_cluster_id", F.concat(F.lit("base_"), (F.col("value_count") % 10).cast("string"))
    )
    return R.graph_links(R.graph_nodes(t.clusters(), t.names(), limit=25), prefixed)


FIELD_HEALTH = f"""SELECT c.field_name, count(*) AS total_clusters, count(n.display_name) AS named_clusters,
  count(*) - count(n.display_name) AS unnamed_clusters, count(*) FILTER ({ANOMALY}) AS anomaly_clusters,
  round(avg(cluster_size), 1) AS avg_cluster_size, max(cluster_size) AS max_cluster_size,
  round(count(n.display_name) / count(*), 3) AS naming_rate, round(count(*) FILTER ({ANOMALY}) / count(*), 3) AS anomaly_rate
  FROM (SELECT * EXCLUDE (display_name) FROM fx_clusters) c LEFT JOIN fx_names n USING (field_name, cluster_id, run_id, cluster_version)
  GROUP BY c.field_name"""


@reg("field_health", "H10", "SELECT * FROM fh", "fx_clusters", "fx_names", fh=FIELD_HEALTH)
def _(t):
    return R.field_health(t.clusters(), t.names())


@reg(
    "duplicate_names", "H11",
    """SELECT display_name, count(*) AS cluster_count, string_agg(DISTINCT field_name, ',' ORDER BY field_name) AS fields
    FROM fx_names GROUP BY display_name HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 50""",
    "fx_names",
)
def _(t):
    return R.duplicate_names(t.names()).withColumn("fields", F.array_join("fields", ","))


@reg(
    "same_field_duplicates", "H12",
    """SELECT field_name, run_id, cluster_version, display_name, count(*) AS cluster_count FROM fx_names
    GROUP BY ALL HAVING count(*) > 1""",
    "fx_names",
)
def _(t):
    return R.same_field_duplicates(t.names())


@reg(
    "cross_field_duplicates", "H12",
    """SELECT display_name, count(DISTINCT field_name) AS field_count, count(*) AS cluster_count,
      string_agg(DISTINCT field_name, ',' ORDER BY field_name) AS fields
    FROM fx_names GROUP BY display_name HAVING count(DISTINCT field_name) > 1""",
    "fx_names",
)
def _(t):
    return R.cross_field_duplicates(t.names()).withColumn("fields", F.array_join("fields", ","))


@reg(
    "insights", "H13",
    """SELECT 'high_anomaly_' || field_name AS id, 'anomaly' AS category,
        CASE WHEN p > 30 THEN 'critical' WHEN p > 15 THEN 'warning' ELSE 'info' END AS severity, p || '%' AS value, p / 100.0::DOUBLE AS metric,
        field_name AS affected_field, anomaly_clusters AS affected_count
      FROM (SELECT *, cast(round(anomaly_clusters / total_clusters * 100) AS BIGINT) AS p FROM fh WHERE total_clusters >= 3
        ORDER BY anomaly_clusters / total_clusters DESC, field_name LIMIT 3) WHERE anomaly_clusters > 0
    UNION ALL SELECT 'low_naming_' || field_name, 'naming', CASE WHEN p > 50 THEN 'critical' ELSE 'warning' END, p || '% unnamed', p / 100.0::DOUBLE,
        field_name, unnamed_clusters
      FROM (SELECT *, cast(round(unnamed_clusters / total_clusters * 100) AS BIGINT) AS p FROM fh WHERE total_clusters >= 5
        ORDER BY named_clusters / total_clusters, field_name LIMIT 3) WHERE p >= 10
    UNION ALL SELECT 'duplicate_names', 'naming', CASE WHEN d > 20 THEN 'critical' WHEN d > 5 THEN 'warning' ELSE 'info' END, d || ' names', d::DOUBLE, NULL, e
      FROM (SELECT count(DISTINCT name) AS d, cast(sum(c - 1) AS BIGINT) AS e FROM (SELECT name, field_name, count(*) AS c FROM strict
        WHERE name <> '' AND NOT coalesce(is_true_anomaly_cluster, false) GROUP BY ALL HAVING count(*) > 1)) WHERE d > 0
    UNION ALL SELECT 'generic_names', 'naming', CASE WHEN n > 5 THEN 'warning' ELSE 'info' END, n || ' clusters', n::DOUBLE, NULL, n
      FROM (SELECT count(*) AS n FROM strict WHERE length(name) <= 4 OR lower(name) IN (GENERIC)) WHERE n > 0
    UNION ALL SELECT 'centroids_' || field_name, 'quality', CASE WHEN p > 30 THEN 'critical' ELSE 'warning' END, p || '% missing', p / 100.0::DOUBLE, field_name, missing
      FROM (SELECT field_name, count(*) FILTER (centroid_embedding IS NULL) AS missing, cast(round(count(*) FILTER (centroid_embedding IS NULL) / count(*) * 100) AS BIGINT) AS p
        FROM fx_clusters GROUP BY field_name HAVING count(*) FILTER (centroid_embedding IS NULL) > 0 ORDER BY missing DESC, field_name LIMIT 3)
    UNION ALL SELECT 'over_compressed', 'quality', 'warning', n || ' clusters', n::DOUBLE, f, n FROM (
      SELECT count(*) AS n, first(field_name ORDER BY cluster_size DESC, id) AS f FROM (SELECT c.* FROM fx_clusters c
        LEFT JOIN (SELECT field_name, final_cluster_id AS cluster_id, count(DISTINCT raw_label) AS lc FROM fx_label_map GROUP BY ALL) l USING (field_name, cluster_id)
        WHERE cluster_size >= 20 AND coalesce(lc, 0) <= 2)) WHERE n > 0""".replace(
        "GENERIC", X.quoted(GENERIC_NAMES)),
    *STATE, strict=STRICT, fh=FIELD_HEALTH,
)
def _(t):
    return R.insights(*state(t))


@reg(
    "review_priorities", "H14",
    f"""SELECT id, round(least(1.0, s), 6)::DOUBLE AS priority_score, reasons FROM (
      SELECT *, CASE WHEN {ANOMALY} THEN 0.35 ELSE 0 END + CASE WHEN name IS NULL THEN 0.30 ELSE 0 END
        + CASE WHEN lower(name) IN ({X.quoted(GENERIC_NAMES)}) THEN 0.20 ELSE 0 END + CASE WHEN cluster_size >= 20 AND coalesce(label_count, 0) <= 2 THEN 0.25 ELSE 0 END
        + CASE WHEN cluster_size >= 10 AND total_occurrences <= 5 THEN 0.15 ELSE 0 END + CASE WHEN length(name) <= 3 THEN 0.10 ELSE 0 END AS s,
        concat_ws(',', CASE WHEN {ANOMALY} THEN 'anomaly' END, CASE WHEN name IS NULL THEN 'unnamed' END,
          CASE WHEN lower(name) IN ({X.quoted(GENERIC_NAMES)}) THEN 'generic_name' END, CASE WHEN cluster_size >= 20 AND coalesce(label_count, 0) <= 2 THEN 'over_compressed' END,
          CASE WHEN cluster_size >= 10 AND total_occurrences <= 5 THEN 'low_occurrence' END, CASE WHEN length(name) <= 3 THEN 'short_name' END) AS reasons
      FROM strict LEFT JOIN labels_per USING (field_name, run_id, cluster_id)) WHERE s > 0 ORDER BY s DESC, cluster_size DESC, id LIMIT 30""",
    *STATE, strict=STRICT, labels_per=LABELS,
)
def _(t):
    return R.review_priorities(*state(t)).select("id", "priority_score", F.array_join("reasons", ",").alias("reasons"))


COMPRESSION = """SELECT field_name, count(*) AS cluster_count, cast(sum(cluster_size) AS BIGINT) AS label_count, min(cluster_size) AS min_size,
  max(cluster_size) AS max_size, round(avg(cluster_size), 1) AS avg_size, round(sum(cluster_size) / count(*), 1) AS compression_ratio
  FROM fx_clusters GROUP BY field_name"""


@reg("compression", "H15", COMPRESSION, "fx_clusters")
def _(t):
    return R.compression(t.clusters())


@reg(
    "compression_totals", "H15",
    """SELECT count(*) AS total_clusters, cast(sum(cluster_size) AS BIGINT) AS total_items,
      (SELECT count(DISTINCT raw_label) FROM fx_label_map) AS raw_label_count,
      round((SELECT count(DISTINCT raw_label) FROM fx_label_map) / count(*), 1) AS compression_ratio FROM fx_clusters""",
    *STATE,
)
def _(t):
    return R.compression_totals(t.clusters(), t.label_map())


RECOVERY = """SELECT field_name, count(*) AS total_labels, count(*) FILTER (base_cluster_id <> final_cluster_id) AS recovered_labels,
  count(*) FILTER (final_cluster_source = 'strict_graph_recovery') AS graph_recovered_labels,
  round(count(*) FILTER (base_cluster_id <> final_cluster_id) / count(*), 3) AS rescue_rate FROM fx_label_map GROUP BY field_name"""


@reg("recovery", "H16", RECOVERY, "fx_label_map")
def _(t):
    return R.recovery(t.label_map())


POOL = f"""SELECT *, lower(trim(medoid_label)) IN ({X.quoted(WEAK_MEDOIDS)}) OR length(trim(medoid_label)) <= 2
    OR regexp_full_match(trim(medoid_label), '\\d+(\\.\\d+)?') AS is_weak FROM strict WHERE medoid_label <> ''"""


@reg(
    "medoid_examples", "H17",
    """SELECT id, is_weak, medoid_label, cast(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY is_weak
      ORDER BY cluster_size DESC, id) AS rank FROM pool) WHERE rank <= 8""",
    "fx_clusters", "fx_names", strict=STRICT, pool=POOL,
)
def _(t):
    return R.medoid_examples(t.clusters(), t.names()).select("id", "is_weak", "medoid_label", "rank")


MEDOID_FIELD = """SELECT field_name, count(*) AS total, count(*) FILTER (is_weak) AS weak,
  round(count(*) FILTER (is_weak) / count(*), 3) AS weak_rate FROM pool GROUP BY field_name"""


@reg("medoid_by_field", "H17", MEDOID_FIELD, "fx_clusters", "fx_names", strict=STRICT, pool=POOL)
def _(t):
    return R.medoid_by_field(t.clusters(), t.names())


@reg("medoid_coverage", "H17",
     """SELECT count(*) AS total_clusters, count(*) FILTER (medoid_label <> '') AS with_medoid,
       round(count(*) FILTER (medoid_label <> '') / count(*), 3) AS coverage_rate FROM fx_clusters""", "fx_clusters")
def _(t):
    return R.medoid_coverage(t.clusters())


@reg(
    "run_metadata", "H18",
    """SELECT run_id, field_name, n_total - n_quarter AS recovered_labels, n_quarter AS true_anomaly_labels,
      round(n_quarter / n_total, 6) AS label_recovery_rate, 0.82::DOUBLE AS similarity_threshold, n_quarter AS graph_communities_found
    FROM fx_cluster_runs""",
    "fx_cluster_runs",
)
def _(t):
    return R.run_metadata(t.cluster_runs()).select(
        "run_id", "field_name", "recovered_labels", "true_anomaly_labels",
        F.round("label_recovery_rate", 6).alias("label_recovery_rate"), "similarity_threshold", "graph_communities_found",
    )


@reg(
    "field_matrix", "H28",
    """SELECT *, CASE WHEN review_score > 0.45 THEN 'High' WHEN review_score > 0.18 THEN 'Monitor' ELSE 'Stable' END AS status FROM (
      SELECT field_name, c.label_count AS raw_labels, h.total_clusters AS clusters, h.naming_rate AS named_rate, h.anomaly_rate,
        a.n AS anomaly_clusters, m.weak_rate AS medoid_weak_rate, r.rescue_rate AS recovery_rate,
        round(h.anomaly_rate * 1.4 + greatest(0.0, 1 - h.naming_rate) + coalesce(m.weak_rate, 0) * 0.7, 6) AS review_score, u.run_id
      FROM comp c FULL JOIN fh h USING (field_name) FULL JOIN anom a USING (field_name) FULL JOIN med m USING (field_name)
      FULL JOIN rec r USING (field_name) FULL JOIN newest u USING (field_name))""",
    *STATE, "fx_cluster_runs", strict=STRICT, pool=POOL, comp=COMPRESSION, fh=FIELD_HEALTH, med=MEDOID_FIELD, rec=RECOVERY,
    anom=f"SELECT field_name, count(*) AS n FROM fx_clusters WHERE {ANOMALY} GROUP BY field_name",
    newest="""SELECT field_name, first(run_id ORDER BY created_at, run_id) AS run_id FROM (
      SELECT * FROM fx_cluster_runs) GROUP BY field_name""",
)
def _(t):
    return R.field_matrix(*state(t), t.cluster_runs()).select(
        "field_name", "raw_labels", "clusters", "named_rate", "anomaly_rate", "anomaly_clusters", "medoid_weak_rate",
        "recovery_rate", "review_score", "run_id", "status",
    )


@reg(
    "action_items", "H29",
    f"""SELECT * FROM (
      SELECT 1 AS position, 'Production emerging labels' AS title, 'warning' AS severity, count(*) AS metric FROM run
        WHERE mapping_status IN ('NEW_CLUSTER_CANDIDATE', 'TRUE_ANOMALY')
      UNION ALL SELECT 2, 'Production config issues', 'critical', count(*) FROM run WHERE mapping_status = 'NO_CLUSTER_REFERENCE'
      UNION ALL SELECT 3, 'Centroid rebuild needed', 'critical', count(*) FROM fx_clusters WHERE centroid_embedding IS NULL
      UNION ALL SELECT 4, 'Weak medoid examples found', 'warning', count(*) FROM pool WHERE is_weak
      UNION ALL SELECT 5, 'Same-field duplicate names', 'warning', count(*) FROM (SELECT 1 FROM fx_names
        GROUP BY field_name, run_id, cluster_version, display_name HAVING count(*) > 1)
      UNION ALL (SELECT 6, field_name || ' anomaly pressure', CASE WHEN count(*) > 1000 THEN 'critical' ELSE 'warning' END, count(*) FROM fx_clusters
        WHERE {ANOMALY} GROUP BY field_name ORDER BY count(*) DESC, field_name LIMIT 1)
      UNION ALL SELECT 7, 'Drift comparison not active', 'info', NULL) WHERE metric > 0 OR position = 7 ORDER BY position LIMIT 6""",
    *STATE, "fx_outputs", strict=STRICT, pool=POOL,
    run="""SELECT * FROM fx_outputs WHERE mapper_run_id = (SELECT mapper_run_id FROM fx_outputs GROUP BY mapper_run_id
      ORDER BY max(created_at) DESC LIMIT 1)""",
)
def _(t):
    return R.action_items(t.clusters(), t.names(), t.outputs())


@reg(
    "confidence_overlay", "H30 E18",
    """SELECT id, score AS semantic_score, CASE WHEN score >= 0.75 THEN 'confident' WHEN score >= 0.6 THEN 'possible' ELSE 'weak' END AS confidence
    FROM fx_clusters JOIN hits USING (field_name, cluster_id) ORDER BY score DESC, id LIMIT 4""",
    "fx_clusters", "fx_outputs",
    hits="""SELECT field_name, mapped_cluster_id AS cluster_id, round(avg(k) / 100, 6) AS score FROM fx_outputs
      WHERE mapped_cluster_id IS NOT NULL GROUP BY ALL""",
)
def _(t):
    hits = t.outputs().filter("mapped_cluster_id IS NOT NULL").groupBy(
        "field_name", F.col("mapped_cluster_id").alias("cluster_id")
    ).agg(F.round(F.avg("k") / 100, 6).alias("semantic_score"))
    return R.confidence_overlay(t.clusters(), hits).select("id", "semantic_score", "confidence")


@reg(
    "cluster_quality", "H31",
    """SELECT c.id, c.shown IS NOT NULL AS is_named, c.centroid_embedding IS NOT NULL AS has_centroid,
      c.medoid_label IS NOT NULL OR c.medoid_similarity_to_centroid IS NOT NULL AS has_medoid,
      NOT coalesce(c.is_true_anomaly_cluster, false) AS not_anomalous, cast(len(c.centroid_embedding) AS INT) AS vector_length,
      round(CASE WHEN c.medoid_similarity_to_centroid IS NOT NULL THEN greatest(0, least(1, 1 - (1 - c.medoid_similarity_to_centroid) * 1.8)) END, 6) AS tightness,
      round(CASE WHEN c.medoid_similarity_to_centroid IS NOT NULL THEN greatest(0, least(1, c.medoid_similarity_to_centroid - 0.16)) END, 6) AS guessed_mean_similarity,
      round(m.mc, 6) AS mean_member_cosine
    FROM strict c LEFT JOIN (SELECT l.field_name, l.cluster_id, avg(list_cosine_similarity(l.v, f.centroid_embedding)) AS mc
      FROM fx_label_vectors l JOIN fx_clusters f USING (field_name, cluster_id) GROUP BY ALL) m USING (field_name, cluster_id)""",
    *STATE, strict=STRICT,
)
def _(t):
    members = t.label_vectors().select("field_name", "cluster_id", F.col("v").alias("embedding"))
    return R.cluster_quality(t.clusters(), t.names(), members)


@reg(
    "label_shares", "H32",
    """SELECT field_name, cluster_id, raw_label, value_count, cast(rank AS INT) AS rank, round(value_count / mx, 6) AS share,
      cast(sum(value_count) OVER (PARTITION BY field_name, cluster_id) AS BIGINT) AS total_shown,
      n - count(*) OVER (PARTITION BY field_name, cluster_id) AS hidden
    FROM (SELECT field_name, final_cluster_id AS cluster_id, raw_label, value_count,
        row_number() OVER (PARTITION BY field_name, final_cluster_id ORDER BY value_count DESC, raw_label) AS rank,
        max(value_count) OVER (PARTITION BY field_name, final_cluster_id) AS mx,
        count(*) OVER (PARTITION BY field_name, final_cluster_id) AS n FROM fx_label_map) WHERE rank <= 10""",
    "fx_label_map",
)
def _(t):
    return R.label_shares(t.label_map(), 10)
