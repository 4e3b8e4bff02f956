"""Queries over sources, sinks and state tables."""

import uuid

from pyspark.sql import functions as F

from ..functions import text
from ..lineage import checkpoint_dir
from ..operators import labels
from ..oracles import expr as X
from ..oracles.fixtures import with_tables
from ..registry import query
from ..sources import io
from .text_jobs import CALL_FIELDS, facts

START, END = "2024-01-08T00:00:00Z", "2024-01-22T00:00:00Z"
WINDOW_SQL = ">= TIMESTAMP '2024-01-08' AND {0} < TIMESTAMP '2024-01-22'"


def in_window(c: str) -> str:
    return f"{c} >= TIMESTAMP '2024-01-08' AND {c} < TIMESTAMP '2024-01-22'"


_PREPARED = f"""
  SELECT field_name AS source_column, raw_label AS raw_value, value_count,
    {X.norm_cluster('raw_label')} AS normalized_value,
    row_number() OVER (ORDER BY field_name, raw_label) - 1 AS global_label_id FROM label_facts"""


@query("label_csv_round_trip", "A1 A3 A14", with_tables(_PREPARED, "fx_calls", **X.label_facts()))
def _(t):
    path = f"{checkpoint_dir(t.spark)}/label-csv-{uuid.uuid4().hex}"
    rows = facts(t).select(
        F.col("field_name").alias("source_column"), F.col("raw_label").alias("raw_value"), "value_count"
    )
    io.export(rows, path, "csv")
    return io.prepare_labels(io.read_label_csv(t.spark, path))


@query(
    "read_label_sql", "A2",
    with_tables(
        """SELECT call_type AS source_column, main_reason AS raw_value, count(*) AS value_count
        FROM fx_calls GROUP BY ALL""",
        "fx_calls",
    ),
)
def _(t):
    return io.read_label_sql(
        t.spark,
        "SELECT call_type AS source_column, main_reason AS raw_value, count(*) AS value_count "
        "FROM {calls} GROUP BY call_type, main_reason",
        calls=t.calls(),
    )


@query(
    "prepare_labels", "A3",
    """SELECT source AS source_column, text AS raw_value,
      CASE WHEN doc_id % 3 = 0 THEN 1 ELSE n_chars END AS value_count, 'd' || doc_id AS normalized_value,
      row_number() OVER (ORDER BY encode(source), encode(text), CASE WHEN doc_id % 3 = 0 THEN 1 ELSE n_chars END,
        encode('d' || doc_id)) - 1 AS global_label_id
    FROM documents WHERE length(trim(text)) > 0""",
)
def _(t):
    rows = t.given("documents").select(
        F.col("source").alias("source_column"),
        F.col("text").alias("raw_value"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("n/a")).otherwise(F.col("n_chars").cast("string"))
        .alias("value_count"),
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("normalized_value"),
    )
    return io.prepare_labels(rows)


@query(
    "read_call_window", "A5 A6",
    with_tables(
        f"""SELECT call_id, call_type, additional_tags, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created
        FROM fx_calls WHERE {in_window('created_at')} AND sequence = 1""",
        "fx_calls",
    ),
)
def _(t):
    rows = io.read_call_window(
        t.calls(), ["call_id", "call_type", "additional_tags", "call_id"], "created_at", START, END,
        where="sequence = 1",
    )
    return rows.withColumn("created", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).drop("created_at")


@query(
    "id_range_counts", "A7",
    """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)
    SELECT cast(floor((o_orderkey - lo) / ceil((hi - lo + 1) / 8.0)) AS BIGINT) AS range_no,
      count(*) AS n_rows, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
    FROM orders, b GROUP BY 1""",
)
def _(t):
    return io.range_counts(t.given("orders"), "o_orderkey", 8)


HISTORY_STEPS = {
    "h": """SELECT trim(coalesce(nullif(field_name, ''), field, '')) AS f,
        coalesce(nullif(label, ''), raw_label) AS raw,
        coalesce(nullif(count, ''), occurrences, '1') AS c FROM fx_history""",
    "history_counts": f"""SELECT f AS field_name, {X.norm_loose('raw')} AS normalized_label,
        cast(sum(coalesce(cast(trunc(try_cast(c AS DOUBLE)) AS BIGINT), 1)) AS BIGINT) AS historical_count
      FROM h WHERE f <> '' AND {X.norm_loose('raw')} IS NOT NULL
        AND coalesce(cast(trunc(try_cast(c AS DOUBLE)) AS BIGINT), 1) > 0 GROUP BY ALL""",
}


@query("read_history_counts", "A8", with_tables("SELECT * FROM history_counts", "fx_history", **HISTORY_STEPS))
def _(t):
    return io.read_history_counts(t.history())


@query(
    "upsert_queue", "A9",
    with_tables(
        """SELECT coalesce(q.field_name, s.field_name) AS field_name,
          coalesce(q.normalized_label, s.normalized_label) AS normalized_label,
          greatest(q.occurrence_count, s.occurrence_count) AS occurrence_count,
          coalesce(s.distinct_call_count, q.distinct_call_count) AS distinct_call_count,
          strftime(coalesce(q.first_seen, s.first_seen), '%Y-%m-%d %H:%M:%S') AS first_seen,
          strftime(coalesce(s.last_seen, q.last_seen), '%Y-%m-%d %H:%M:%S') AS last_seen
        FROM (SELECT * FROM fx_queue WHERE resolver_status IS NOT NULL) q
        FULL JOIN src s ON q.field_name = s.field_name AND q.normalized_label = s.normalized_label""",
        "fx_queue",
        src="""SELECT field_name, normalized_label, max(k) + 100 AS occurrence_count,
          cast(1 AS BIGINT) AS distinct_call_count, max(classified_at) AS first_seen, max(classified_at) AS last_seen
          FROM fx_outputs WHERE normalized_label <> '' GROUP BY ALL""",
    ),
)
def _(t):
    source = t.outputs().filter("normalized_label <> ''").select(
        "field_name", "normalized_label", (F.col("k") + 100).alias("occurrence_count"),
        F.lit(1).cast("bigint").alias("distinct_call_count"),
        F.col("classified_at").alias("first_seen"), F.col("classified_at").alias("last_seen"),
    )
    target = t.queue().filter("resolver_status IS NOT NULL").select(
        "field_name", "normalized_label", "occurrence_count", "distinct_call_count", "first_seen", "last_seen"
    )
    out = io.upsert(
        target, source, ["field_name", "normalized_label"],
        {"occurrence_count": "greatest", "first_seen": "keep"},
        newest_first=[F.col("last_seen").desc()],
    )
    fmt = "yyyy-MM-dd HH:mm:ss"
    return out.withColumns({c: F.date_format(c, fmt) for c in ("first_seen", "last_seen")})


@query(
    "update_or_insert_labels", "A10",
    with_tables(
        """SELECT m.field_name, m.raw_label, m.normalized_label,
          coalesce(s.final_cluster_id, m.final_cluster_id) AS final_cluster_id, m.value_count
        FROM fx_label_map m LEFT JOIN src s USING (field_name, normalized_label)
        UNION ALL
        SELECT s.field_name, s.raw_label, s.normalized_label, s.final_cluster_id, NULL
        FROM src s ANTI JOIN fx_label_map m USING (field_name, normalized_label)""",
        "fx_label_map", "fx_outputs",
        src="""SELECT DISTINCT field_name, raw_label, normalized_label, 'anom_' || k AS final_cluster_id
          FROM fx_outputs WHERE mapping_status = 'TRUE_ANOMALY' AND normalized_label <> ''""",
    ).replace("coalesce(s.final_cluster_id, m.final_cluster_id)", "coalesce(s.final_cluster_id, m.final_cluster_id)"),
)
def _(t):
    source = (
        t.outputs().filter("mapping_status = 'TRUE_ANOMALY' AND normalized_label <> ''")
        .select("field_name", "raw_label", "normalized_label",
                F.concat(F.lit("anom_"), F.col("k").cast("string")).alias("final_cluster_id"))
        .distinct()
    )
    target = t.label_map().select(
        "field_name", "raw_label", "normalized_label", "final_cluster_id", "value_count"
    )
    return io.update_or_insert(target, source, ["field_name", "normalized_label"])


@query(
    "label_map_rows", "A11 B3",
    with_tables(
        """SELECT field_name, trim(item) AS raw_label, count(*) AS n, 'run_1' AS run_id, 'v1' AS cluster_version
        FROM items WHERE lower(trim(item)) NOT IN ('', 'nan', 'none', 'null') GROUP BY ALL""",
        "fx_calls", **X.call_labels(),
    ),
)
def _(t):
    long = labels.long_cells(t.calls(), [], CALL_FIELDS)
    items = labels.explode_positions(long, ["field_name"], text.split_label_items(F.col("_cell")), "p", "raw_label")
    rows = io.label_map_rows(items, "run_1", "v1")
    return rows.groupBy("field_name", "raw_label", "run_id", "cluster_version").agg(F.count("*").alias("n"))


@query(
    "deactivate_fields", "A12",
    with_tables(
        """SELECT id, CASE WHEN field_name IN ('field_0', 'field_2') AND coalesce(active, true) THEN false
          ELSE active END AS active FROM fx_clusters""",
        "fx_clusters",
    ),
)
def _(t):
    return io.deactivate(t.clusters(), ["field_0", "field_2"]).select("id", "active")


@query(
    "run_record", "A13 A14",
    with_tables(
        """SELECT unnest(['status', 'rows_seen', 'fields', 'mean_score', 'first_day']) AS metric,
          unnest(['SUCCESS', cast(n AS VARCHAR), cast(f AS VARCHAR), cast(s AS VARCHAR), cast(d AS VARCHAR)]) AS value
        FROM (SELECT count(*) AS n, count(DISTINCT field_name) AS f, cast(min(classified_at) AS DATE) AS d,
          cast(sum(k) AS BIGINT) AS s FROM fx_outputs)""",
        "fx_outputs",
    ).replace("'mean_score'", "'score_sum'"),
)
def _(t):
    one = t.outputs().agg(
        F.lit("SUCCESS").alias("status"),
        F.count("*").alias("rows_seen"),
        F.countDistinct("field_name").alias("fields"),
        F.sum("k").alias("score_sum"),
        F.to_date(F.min("classified_at")).alias("first_day"),
    )
    return io.report_rows(one)


for _kind, _statuses, _extra in (
    ("canonical", "'EXISTING_CLUSTER', 'KNOWN_TRUE_ANOMALY'",
     "mapped_cluster_id, mapped_display_name, cluster_version, mapping_method"),
    ("emerging", "'NEW_CLUSTER_CANDIDATE', 'TRUE_ANOMALY'", "mapping_status, cluster_version"),
    ("config_issue", "'NO_CLUSTER_REFERENCE'", "mapping_status"),
):
    _cols = (
        "source_db, source_table, source_record_id, field_name, raw_label, normalized_label, "
        f"mapper_run_id, {_extra}"
    )

    def _feed(t, kind=_kind, cols=_cols):
        return io.feed_views(t.outputs())[kind].select(*cols.split(", "))

    query(
        f"feed_{_kind}_rows", "A16",
        with_tables(f"SELECT {_cols} FROM fx_outputs WHERE mapping_status IN ({_statuses})", "fx_outputs"),
    )(_feed)
