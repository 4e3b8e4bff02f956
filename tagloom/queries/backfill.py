"""Queries over the backfill of label columns."""

import uuid

from pyspark.sql import functions as F

from ..functions.lists import ACRONYMS_BACKFILL
from ..lineage import checkpoint_dir, cut
from ..operators import backfill as B
from ..operators import labels as L
from ..oracles import expr as X
from ..oracles.fixtures import with_tables
from ..registry import ENTRIES, query
from ..sources import io
from .mapping import ACTIVE
from .tables import HISTORY_STEPS
from .weekly import STANDARD_NAMES

REFS = f"""SELECT c.field_name, c.cluster_id, c.run_id, c.cluster_version,
    coalesce(n.display_name, c.display_name, c.cluster_id) AS display_name,
    coalesce(c.is_true_anomaly_cluster, false) OR c.cluster_source = 'true_anomaly' AS is_anomaly,
    c.cluster_size, c.total_occurrences, c.medoid_label, c.centroid_embedding
  FROM fx_clusters c LEFT JOIN fx_names n USING (field_name, cluster_id, run_id, cluster_version)
  WHERE {ACTIVE.replace('active', 'c.active')}"""
INDEX_STEPS = {
    "refs": REFS,
    "texts": """SELECT field_name, cluster_id, is_anomaly, total_occurrences, cluster_size, display_name,
        unnest([display_name, medoid_label]) AS text FROM refs
      UNION ALL SELECT m.field_name, m.final_cluster_id, coalesce(r.is_anomaly, m.final_is_true_anomaly),
        coalesce(r.total_occurrences, 0), coalesce(r.cluster_size, 0), coalesce(r.display_name, m.final_cluster_id),
        unnest([m.raw_label, m.normalized_label, r.display_name])
      FROM fx_label_map m LEFT JOIN refs r ON r.field_name = m.field_name AND r.cluster_id = m.final_cluster_id""",
    "ix": f"""SELECT field_name, key, cluster_id, display_name, is_anomaly FROM (
        SELECT *, unnest([{X.norm_exact('text')}, {X.norm_loose('text')}]) AS key FROM texts WHERE text IS NOT NULL)
      WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY field_name, key
        ORDER BY is_anomaly, total_occurrences DESC, cluster_size DESC, cluster_id DESC) = 1""",
}
TABLES = ("fx_clusters", "fx_names", "fx_label_map")


def index_of(t):
    refs = B.cluster_refs(t.clusters(), t.names())
    return refs, B.exact_index(refs, t.label_map())


@query("exact_index", "G25", with_tables("SELECT * FROM ix", *TABLES, **INDEX_STEPS))
def _(t):
    return index_of(t)[1].select("field_name", "key", "cluster_id", "display_name", "is_anomaly")


@query(
    "active_run_ids", "G32",
    with_tables(
        """SELECT f.field_name, coalesce(r.run_id, m.run_id, 'clean_auto') AS active_run
        FROM (SELECT DISTINCT field_name FROM fx_outputs UNION SELECT 'main_reason') f
        LEFT JOIN (SELECT field_name, run_id FROM fx_cluster_runs WHERE field_name <> 'field_2'
          QUALIFY row_number() OVER (PARTITION BY field_name ORDER BY created_at DESC, run_id) = 1) r USING (field_name)
        LEFT JOIN (SELECT field_name, run_id, count(*) AS n FROM fx_label_map GROUP BY field_name, run_id
          QUALIFY row_number() OVER (PARTITION BY field_name ORDER BY n DESC, run_id) = 1) m USING (field_name)""",
        "fx_outputs", "fx_cluster_runs", "fx_label_map",
    ),
)
def _(t):
    fields = t.outputs().select("field_name").union(t.history().select(F.lit("main_reason")))
    runs = t.cluster_runs().filter("field_name <> 'field_2'")
    return B.active_run_ids(fields, t.label_map(), "clean_auto", t.outputs(), runs)


# Labels to decide: those of the mapper outputs (known to the label map in part), of the
# calls' reasons (part of them with a history) and made-up spellings of cluster names.
DECIDE_STEPS = INDEX_STEPS | HISTORY_STEPS | {
    "found": """SELECT field_name, raw_label, count(*) AS label_count FROM fx_outputs GROUP BY ALL
      UNION ALL SELECT 'main_reason', main_reason, count(*) FROM fx_calls GROUP BY ALL
      UNION ALL SELECT field_name, upper(replace(display_name, ' ', '_')), cluster_size::BIGINT FROM refs
      UNION ALL SELECT field_name, 'New Thing ' || k, count(*) FROM fx_outputs GROUP BY ALL""",
    "grp": f"""SELECT field_name, n AS normalized_label, first(raw_label ORDER BY c DESC, raw_label) AS raw_label,
        cast(sum(c) AS BIGINT) AS occurrence_count FROM (
          SELECT field_name, raw_label, {X.norm_loose('raw_label')} AS n, sum(label_count) AS c FROM found GROUP BY ALL)
      WHERE n IS NOT NULL GROUP BY field_name, n""",
    "decided": f"""SELECT g.*, coalesce(h.historical_count, 0) AS historical_count,
        coalesce(i1.cluster_id, i2.cluster_id) AS hit, coalesce(i1.display_name, i2.display_name) AS hit_name,
        coalesce(i1.is_anomaly, i2.is_anomaly) AS hit_anomaly
      FROM grp g LEFT JOIN ix i1 ON i1.field_name = g.field_name AND i1.key = {X.norm_exact('g.raw_label')}
      LEFT JOIN ix i2 ON i2.field_name = g.field_name AND i2.key = g.normalized_label
      LEFT JOIN history_counts h ON h.field_name = g.field_name AND h.normalized_label = g.normalized_label""",
    "decisions": f"""SELECT field_name, normalized_label, raw_label, occurrence_count, historical_count,
        CASE WHEN hit_anomaly THEN 'PROMOTE_EXISTING_ANOMALY_TO_STANDARD' WHEN hit IS NOT NULL THEN 'MAP_TO_EXISTING_STANDARD'
          WHEN historical_count > 0 THEN 'CREATE_STANDARD_FROM_HISTORICAL_UNRESOLVED' ELSE 'CREATE_TRUE_ANOMALY_NEW_LABEL' END AS action,
        coalesce(hit, CASE WHEN historical_count > 0 THEN 'clean_std_' ELSE 'clean_anom_' END
          || left(sha256(field_name || '||' || normalized_label), 18)) AS cluster_id,
        coalesce(hit_name, {X.display_name('normalized_label', ACRONYMS_BACKFILL)}) AS display_name,
        CASE WHEN hit_anomaly THEN 'exact_existing_anomaly_promoted' WHEN hit IS NOT NULL THEN 'exact_existing_standard'
          WHEN historical_count > 0 THEN 'historical_unresolved_promoted_to_standard' ELSE 'new_unseen_label_true_anomaly' END AS source
      FROM decided""",
}
DECIDE_TABLES = TABLES + ("fx_outputs", "fx_calls", "fx_history")


def decisions_of(t):
    refs, index = index_of(t)
    out = cut(t.outputs().groupBy("field_name", "raw_label", "k").agg(F.count("*").alias("label_count")))  # read twice
    reasons = t.calls().groupBy(F.col("main_reason").alias("raw_label")).agg(F.count("*").alias("label_count"))
    found = (
        out.select("field_name", "raw_label", "label_count")
        .unionByName(reasons.withColumn("field_name", F.lit("main_reason")))
        .unionByName(refs.select(
            "field_name", F.upper(F.replace("display_name", F.lit(" "), F.lit("_"))).alias("raw_label"),
            F.col("cluster_size").cast("bigint").alias("label_count")))
        .unionByName(out.select(
            "field_name", F.concat(F.lit("New Thing "), F.col("k").cast("string")).alias("raw_label"), "label_count"))
    )
    from ..functions.text import normalize_label

    found = cut(  # read for the groups and for the fields
        found.withColumn("normalized_label", normalize_label(F.col("raw_label"), "loose"))
        .filter("normalized_label IS NOT NULL")
        .groupBy("field_name", "raw_label", "normalized_label").agg(F.sum("label_count").alias("label_count"))
    )
    matched = B.exact_decisions(B.label_groups(found), index)
    history = io.read_history_counts(t.history())
    runs = B.active_run_ids(found, t.label_map(), "clean_auto")
    return B.decide(matched, None, refs, history, runs, "clean_auto")


@query("decide_labels", "G26", with_tables("SELECT * FROM decisions", *DECIDE_TABLES, **DECIDE_STEPS))
def _(t):
    return decisions_of(t).select(
        "field_name", "normalized_label", "raw_label", "occurrence_count", "historical_count", "action",
        "cluster_id", "display_name", "source",
    )


@query(
    "resolve_decision_names", "G27",
    with_tables(
        f"""SELECT field_name, normalized_label, CASE WHEN p IS NULL THEN display_name WHEN free THEN p ELSE
            {X.sanitize("p || ' ' || left(sha256(field_name || '||' || normalized_label), 4)", ACRONYMS_BACKFILL)} END AS display_name,
          coalesce(free, false) AS is_unique
        FROM (SELECT d.*, CASE WHEN p IS NOT NULL THEN NOT EXISTS (SELECT 1 FROM sn WHERE sn.field_name = d.field_name
              AND sn.cluster_id <> d.cluster_id AND {X.name_key('sn.display_name')} = d.k)
            AND d.cluster_id = min(d.cluster_id) OVER (PARTITION BY d.field_name, d.k) END AS free FROM prop d)""",
        *DECIDE_TABLES, **DECIDE_STEPS, sn=STANDARD_NAMES,
        prop=f"""SELECT *, {X.name_key('p')} AS k FROM (SELECT *, CASE WHEN action IN ('PROMOTE_EXISTING_ANOMALY_TO_STANDARD',
            'CREATE_STANDARD_FROM_HISTORICAL_UNRESOLVED') THEN {X.sanitize('display_name', ACRONYMS_BACKFILL)} END AS p
          FROM decisions)""",
    ),
)
def _(t):
    out = B.resolve_decision_names(decisions_of(t), t.names(), t.clusters())
    return out.select(
        "field_name", "normalized_label", "display_name",
        F.coalesce(F.col("naming_method") == "deterministic_standard_name_fallback", F.lit(False)).alias("is_unique"),
    )


@query(
    "backfill_field_audit_rows", "G31",
    with_tables(
        """SELECT field_name, 'CHANGED' AS field_status, raw_label AS old_value, display_name AS new_value,
          CASE action WHEN 'MAP_TO_EXISTING_STANDARD' THEN 'existing_standard' WHEN 'PROMOTE_EXISTING_ANOMALY_TO_STANDARD' THEN 'promoted_anomaly'
            WHEN 'CREATE_STANDARD_FROM_HISTORICAL_UNRESOLVED' THEN 'new_standard_historical' ELSE 'new_anomaly' END AS mapping_method,
          '["' || display_name || '"]' AS mapped_display_names, source AS notes FROM decisions""",
        *DECIDE_TABLES, **DECIDE_STEPS,
    ),
)
def _(t):
    return B.field_audit(decisions_of(t), "run_1").drop("backfill_run_id", "changed")


@query(
    "backfill_queue_rows", "G31",
    with_tables(
        """SELECT field_name, normalized_label, occurrence_count,
          CASE action WHEN 'CREATE_TRUE_ANOMALY_NEW_LABEL' THEN 'ANOMALY' WHEN 'PROMOTE_EXISTING_ANOMALY_TO_STANDARD' THEN 'PROMOTE'
            ELSE 'MAP_TO_EXISTING' END AS resolver_status, cluster_id AS target_cluster_id, display_name AS target_display_name,
          '{"materialized":true,"action":"' || action || '","cluster_id":"' || cluster_id || '","source":"' || source || '"}' AS evidence_json
        FROM decisions""",
        *DECIDE_TABLES, **DECIDE_STEPS,
    ),
)
def _(t):
    return B.queue_rows(decisions_of(t), True).select(
        "field_name", "normalized_label", "occurrence_count", "resolver_status", "target_cluster_id",
        "target_display_name", "evidence_json",
    )


@query(
    "materialize_taxonomy", "G28",
    with_tables(
        """SELECT field_name, final_cluster_id, count(*) AS n_labels, cast(sum(value_count) AS BIGINT) AS weight FROM (
          SELECT m.field_name, coalesce(d.cluster_id, m.final_cluster_id) AS final_cluster_id,
            coalesce(d.occurrence_count, m.value_count) AS value_count
          FROM fx_label_map m LEFT JOIN decisions d USING (field_name, normalized_label)
          UNION ALL SELECT field_name, cluster_id, occurrence_count FROM decisions d
            ANTI JOIN fx_label_map m USING (field_name, normalized_label)) GROUP BY ALL""",
        *DECIDE_TABLES, **DECIDE_STEPS,
    ),
)
def _(t):
    d = decisions_of(t).withColumn("embedding", F.lit(None).cast("array<double>"))
    clusters = t.clusters().withColumn("representative_labels", F.lit(None).cast("array<string>"))
    state = B.materialize(d, B.TaxonomyState(clusters, t.names(), t.label_map(), t.label_embeddings()))
    return state.label_map.groupBy("field_name", "final_cluster_id").agg(
        F.count("*").alias("n_labels"), F.sum("value_count").alias("weight")
    )


# Rewriting rows: decisions of the stage labels themselves, one label in three undecided.
STAGE_FIELDS = ["outcome", "outcome_sub", "additional_tags"]


def stage_decisions(t):
    found = L.discover_labels(t.stage(), STAGE_FIELDS)
    groups = B.label_groups(found).filter(F.length("normalized_label") > 1)
    shown = F.concat(F.lit("Shown "), F.upper("normalized_label"))
    return groups.select("field_name", "normalized_label", shown.alias("display_name"))


def _stage_steps():
    from .text_jobs import stage_label_steps

    return stage_label_steps() | {
        "lab": f"SELECT *, {X.norm_loose('raw_label')} AS n FROM stage_items",
        "cell": """SELECT id, field_name, bool_or(length(n) > 1) AS any_mapped,
            list(CASE WHEN length(n) > 1 THEN 'Shown ' || upper(n) ELSE raw_label END ORDER BY pos) AS mapped
          FROM lab GROUP BY id, field_name""",
        "upd": """SELECT c.id, c.field_name, s.cell AS old_value,
            CASE WHEN c.field_name = 'outcome' THEN mapped[1] ELSE array_to_string(mapped, ', ') END AS new_value
          FROM cell c JOIN stage_cells s USING (id, field_name) WHERE any_mapped""",
    }


@query(
    "cell_updates", "G29 C5 C32",
    with_tables(
        "SELECT *, trim(old_value) <> trim(new_value) AS changed FROM upd", "fx_stage", **_stage_steps()
    ),
)
def _(t):
    return B.cell_updates(t.stage(), stage_decisions(t), STAGE_FIELDS).drop("new_array")


@query(
    "apply_to_rows", "G29",
    with_tables(
        """SELECT s.id, s.call_id, coalesce(o.new_value, s.outcome) AS outcome, coalesce(u.new_value, s.outcome_sub) AS outcome_sub,
          coalesce(a.new_value, s.additional_tags) AS additional_tags
        FROM fx_stage s LEFT JOIN (SELECT * FROM upd WHERE field_name = 'outcome') o USING (id)
        LEFT JOIN (SELECT * FROM upd WHERE field_name = 'outcome_sub') u USING (id)
        LEFT JOIN (SELECT * FROM upd WHERE field_name = 'additional_tags') a USING (id)
        WHERE o.new_value IS NOT NULL OR u.new_value IS NOT NULL OR a.new_value IS NOT NULL""",
        "fx_stage", **_stage_steps(),
    ),
)
def _(t):
    return B.apply_to_rows(t.stage(), stage_decisions(t), STAGE_FIELDS).drop("better_tags_updated_at")


@query(
    "update_counts", "G30",
    with_tables(
        """SELECT count(*) AS rows_scanned, (SELECT count(DISTINCT id) FROM upd WHERE old_value <> new_value) AS rows_changed,
          (SELECT count(*) FROM upd WHERE old_value <> new_value) AS cells_changed,
          count(*) - (SELECT count(DISTINCT id) FROM upd WHERE old_value <> new_value) AS rows_unchanged
        FROM fx_stage""",
        "fx_stage", **_stage_steps(),
    ),
)
def _(t):
    stage = t.stage()
    return B.update_counts(stage, B.cell_updates(stage, stage_decisions(t), STAGE_FIELDS))




@query("update_counts_in_passing", "G30 A13", ENTRIES["update_counts"].sql)
def _(t):
    """The same counts, observed while the changed rows are written."""
    stage = t.stage()
    updates = cut(B.cell_updates(stage, stage_decisions(t), STAGE_FIELDS))
    return B.write_updates(stage, updates, STAGE_FIELDS, f"{checkpoint_dir(t.spark)}/rows-{uuid.uuid4().hex}")
