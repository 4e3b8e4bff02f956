"""Queries over mapper outputs and the backfill monitor."""

from pyspark.sql import functions as F

from ..lineage import cut
from ..operators import reports as R
from ..operators.sketches import approximate_counts, hourly_sketches
from ..sources.pages import cursor
from .reports import reg, ts, ts_sql

LATEST = """SELECT * FROM fx_outputs WHERE mapper_run_id = (SELECT mapper_run_id FROM fx_outputs GROUP BY mapper_run_id
  ORDER BY max(created_at) DESC, mapper_run_id LIMIT 1)"""
NUMBERS = """count(*) AS total_rows, count(DISTINCT source_record_id) AS distinct_calls,
  count(*) FILTER (mapping_status = 'EXISTING_CLUSTER') AS existing_cluster_rows,
  count(*) FILTER (mapping_status = 'NEW_CLUSTER_CANDIDATE') AS new_cluster_candidate_rows,
  count(*) FILTER (mapping_status = 'TRUE_ANOMALY') AS true_anomaly_rows,
  count(*) FILTER (mapping_status = 'NO_CLUSTER_REFERENCE') AS no_cluster_reference_rows"""
RATE = "round(count(*) FILTER (mapping_status = 'EXISTING_CLUSTER') / count(*), 6) AS existing_cluster_rate"


@reg(
    "mapper_summary", "H19",
    f"""SELECT mapper_run_id, {NUMBERS}, count(*) FILTER (mapping_method = 'exact_label_map') AS exact_label_map_rows,
      count(*) FILTER (mapping_method = 'centroid_similarity') AS centroid_similarity_rows,
      count(*) FILTER (mapping_method = 'near_existing_below_threshold') AS near_existing_below_threshold_rows,
      {ts_sql('max(classified_at)')} AS latest_classified_at, {RATE},
      round(count(*) FILTER (mapping_status IN ('NEW_CLUSTER_CANDIDATE', 'TRUE_ANOMALY')) / count(*), 6) AS emerging_rate
    FROM run GROUP BY mapper_run_id""",
    "fx_outputs", run=LATEST,
)
def _(t):
    return ts(R.mapper_summary(t.outputs()), "latest_classified_at")


@reg(
    "mapper_field_health", "H19",
    f"""SELECT field_name, {NUMBERS}, round(avg(similarity_score::DOUBLE), 4) AS avg_similarity, {RATE} FROM run GROUP BY field_name""",
    "fx_outputs", run=LATEST,
)
def _(t):
    return R.mapper_field_health(t.outputs())


@reg(
    "mapper_runs", "H20",
    f"""SELECT mapper_run_id, {NUMBERS}, {ts_sql('max(created_at)')} AS last_written_at FROM fx_outputs
    GROUP BY mapper_run_id ORDER BY max(created_at) DESC LIMIT 20""",
    "fx_outputs",
)
def _(t):
    return ts(R.mapper_runs(t.outputs()), "last_written_at")


for _kind, _where, _status, _order in (
    ("canonical", "mapping_status IN ('EXISTING_CLUSTER', 'KNOWN_TRUE_ANOMALY')", "'EXISTING_CLUSTER'", ""),
    ("emerging", "mapping_status IN ('NEW_CLUSTER_CANDIDATE', 'TRUE_ANOMALY')", "mapping_status", "similarity_score DESC,"),
    ("config_issue", "mapping_status = 'NO_CLUSTER_REFERENCE'", "mapping_status", ""),
):

    def _page(t, kind=_kind):
        cols = ["mapper_run_id", "classified_at", "source_record_id", "field_name", "raw_label", "mapping_status"]
        return ts(R.feed(t.outputs(), kind).select(*cols), "classified_at")

    reg(
        f"feed_{_kind}", "H21",
        f"""SELECT mapper_run_id, {ts_sql('classified_at')} AS classified_at, source_record_id, field_name, raw_label,
          {_status} AS mapping_status FROM (SELECT * FROM fx_outputs WHERE {_where}
          ORDER BY classified_at DESC, {_order} source_record_id, field_name, raw_label LIMIT 300)""",
        "fx_outputs",
    )(_page)

OVERLAY = f"""SELECT field_name, mapped_cluster_id, max(mapped_display_name) AS mapped_display_name, count(*) AS production_hit_count,
  count(DISTINCT source_record_id) AS production_distinct_calls, {ts_sql('max(classified_at)')} AS latest_classified_at,
  array_to_string(list_sort(list_distinct(list(raw_label)))[1:6], ',') AS raw_labels
  FROM run WHERE mapping_status = 'EXISTING_CLUSTER' GROUP BY field_name, mapped_cluster_id
  ORDER BY production_hit_count DESC, field_name, mapped_cluster_id LIMIT 1000"""


@reg("production_overlay", "H22", "SELECT * FROM hits", "fx_outputs", run=LATEST, hits=OVERLAY)
def _(t):
    out = ts(R.production_overlay(t.outputs()), "latest_classified_at")
    return out.withColumn("raw_labels", F.array_join("raw_labels", ","))


@reg(
    "cluster_overlay", "E18",
    """SELECT c.id, h.production_hit_count, h.production_distinct_calls, h.raw_labels FROM fx_clusters c
    LEFT JOIN hits h ON h.field_name = c.field_name AND h.mapped_cluster_id = c.cluster_id""",
    "fx_outputs", "fx_clusters", run=LATEST, hits=OVERLAY,
)
def _(t):
    out = R.overlay(t.clusters(), R.production_overlay(t.outputs()))
    return out.select("id", "production_hit_count", "production_distinct_calls", F.array_join("raw_labels", ",").alias("raw_labels"))


for _name, _status, _test in (
    ("open", None, "NOT coalesce(materialized, false)"),
    ("unreviewed", "null", "resolver_status IS NULL"),
    ("materialized", "MATERIALIZED", "coalesce(materialized, false)"),
    ("promote", "PROMOTE", "resolver_status = 'PROMOTE' AND NOT coalesce(materialized, false)"),
):

    def _rows(t, status=_status):
        page, total = R.queue_filter(t.queue(), status=status, limit=20, offset=2)
        return page.join(F.broadcast(total)).select(
            "field_name", "normalized_label", "occurrence_count", "distinct_call_count", "resolver_status", "total"
        )

    reg(
        f"queue_{_name}", "B7",
        f"""SELECT field_name, normalized_label, occurrence_count, distinct_call_count, resolver_status, count(*) OVER () AS total
        FROM fx_queue WHERE {_test} ORDER BY occurrence_count DESC, distinct_call_count DESC, field_name, normalized_label LIMIT 20 OFFSET 2""",
        "fx_queue",
    )(_rows)


@reg(
    "backfill_summary", "H25",
    """SELECT r.backfill_run_id, r.status, r.rows_scanned, cast(r.rows_changed AS BIGINT) AS rows_changed,
      round(least(100.0::DOUBLE, rows_scanned / rows_pending * 100), 4) AS progress_percent,
      cast(floor(epoch(finished_at)) - floor(epoch(started_at)) AS BIGINT) AS duration_seconds,
      round(rows_scanned / (floor(epoch(finished_at)) - floor(epoch(started_at))), 6) AS rows_per_second, q.*
    FROM (SELECT * FROM fx_backfill_runs ORDER BY started_at DESC LIMIT 1) r, (
      SELECT count(*) FILTER (resolver_status IS NULL) AS pending,
        count(*) FILTER (resolver_status = 'MAP_TO_EXISTING' AND NOT m) AS map_to_existing, count(*) FILTER (resolver_status = 'ANOMALY' AND NOT m) AS anomaly,
        count(*) FILTER (resolver_status = 'PROMOTE' AND NOT m) AS promote, count(*) FILTER (m) AS materialized,
        count(*) FILTER (resolver_status IS NULL OR NOT m) AS total_unresolved
      FROM (SELECT *, coalesce(materialized, false) AS m FROM fx_queue)) q""",
    "fx_backfill_runs", "fx_queue",
)
def _(t):
    return R.backfill_summary(t.backfill_runs(), t.queue())


@reg(
    "backfill_runs", "H26",
    f"""SELECT backfill_run_id, status, {ts_sql('started_at')} AS started_at, rows_scanned, cast(rows_changed AS BIGINT) AS rows_changed,
      cast(rows_error AS BIGINT) AS rows_error, count(*) OVER () AS total FROM fx_backfill_runs ORDER BY fx_backfill_runs.started_at DESC LIMIT 10 OFFSET 5""",
    "fx_backfill_runs",
)
def _(t):
    page, total = R.backfill_runs(t.backfill_runs(), 10, 5)
    return ts(page.join(F.broadcast(total)), "started_at").select(
        "backfill_run_id", "status", "started_at", "rows_scanned", "rows_changed", "rows_error", "total"
    )


@reg(
    "backfill_fields", "H27",
    """SELECT field_name, count(*) AS scanned, count(*) FILTER (field_status = 'CHANGED') AS changed,
      count(*) FILTER (field_status = 'UNCHANGED') AS unchanged, count(*) FILTER (field_status = 'UNMAPPED') AS unmapped,
      count(*) FILTER (field_status = 'AMBIGUOUS') AS ambiguous, count(*) FILTER (field_status = 'ERROR') AS error,
      count(*) FILTER (field_status = 'EMPTY') AS empty, round(100.0::DOUBLE * count(*) FILTER (field_status = 'CHANGED') / count(*), 2) AS changed_pct
    FROM fx_field_audit WHERE backfill_run_id = (SELECT backfill_run_id FROM fx_backfill_runs ORDER BY started_at DESC LIMIT 1)
    GROUP BY field_name""",
    "fx_field_audit", "fx_backfill_runs",
)
def _(t):
    return R.backfill_fields(t.field_audit(), t.backfill_runs())


@reg(
    "row_audit", "E13",
    """SELECT r.id, r.call_id, r.row_status, a.field_name || '=' || a.new_value || '/' || a.field_status AS field_audit FROM (
      SELECT * FROM fx_row_audit WHERE row_status = 'UPDATED' AND backfill_run_id = (SELECT backfill_run_id FROM fx_backfill_runs ORDER BY started_at DESC LIMIT 1)
        AND EXISTS (SELECT 1 FROM fx_field_audit f WHERE f.stage_row_id = fx_row_audit.stage_row_id AND f.field_name = 'field_1') ORDER BY id DESC LIMIT 50 OFFSET 1) r
    JOIN fx_field_audit a USING (stage_row_id)""",
    "fx_row_audit", "fx_field_audit", "fx_backfill_runs",
)
def _(t):
    out = R.row_audit(t.row_audit(), t.field_audit(), t.backfill_runs(), status="UPDATED", field="field_1", offset=1)
    text = F.transform("field_audit", lambda a: F.concat(a["field_name"], F.lit("="), a["new_value"], F.lit("/"), a["field_status"]))
    return out.select("id", "call_id", "row_status", F.array_join(text, ",").alias("field_audit"))


@reg(
    "row_audit_next_page", "E13 H26 A7 B2",
    """SELECT id, call_id, row_status FROM fx_row_audit WHERE row_status = 'UPDATED'
      AND backfill_run_id = (SELECT backfill_run_id FROM fx_backfill_runs ORDER BY started_at DESC LIMIT 1) ORDER BY id DESC LIMIT 50 OFFSET 2""",
    "fx_row_audit", "fx_backfill_runs",
)
def _(t):
    """The page after a first one of two rows, by the key of the last row seen."""
    tables = t.row_audit(), t.field_audit(), t.backfill_runs()
    first = R.row_audit(*tables, status="UPDATED", limit=2).select("id").orderBy(F.col("id").desc()).collect()
    last = cursor(first, [("id", True)])
    return R.row_audit(*tables, status="UPDATED", after=last["id"]).select("id", "call_id", "row_status")


@reg(
    "approximate_calls", "H19 H22 T2",
    """SELECT field_name, mapping_status, count(*) AS n_rows, count(DISTINCT source_record_id) AS calls, true AS within_bound
    FROM fx_outputs WHERE classified_at IS NOT NULL GROUP BY ALL""",
    "fx_outputs",
)
def _(t):
    """Distinct calls from hourly sketches beside the exact ones: within five of the sketch's standard errors, or one."""
    by = ["field_name", "mapping_status"]
    rows = t.outputs().filter("classified_at IS NOT NULL")
    kept = cut(hourly_sketches(rows, by))
    exact = rows.groupBy(*by).agg(F.countDistinct("source_record_id").alias("calls"))
    near = F.abs(F.col("distinct_calls") - F.col("calls")) <= F.greatest(F.lit(1.0), F.col("calls") * 5 * 1.04 / 64)
    return approximate_counts(kept, by).join(exact, by).select(*by, "n_rows", "calls", near.alias("within_bound"))
