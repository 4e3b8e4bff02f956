"""Rows in the shape of the label data, derived from the given tables by plain SQL.

The texts are valid in Spark SQL and in ANSI engines alike; ``{name}`` stands for a table.
Every statement reads its whole tables.
"""

# One call per event. Label cells come as scalars, as text with the three separators, as
# JSON and Python list text, with repeats and with words that mean "no label".
CALLS = """
SELECT c.*,
  CASE id % 3
    WHEN 0 THEN part_name || '|' || call_type || '|' || brand
    WHEN 1 THEN part_name || ';' || call_type || ';' || brand
    ELSE part_name || ',' || call_type || ',' || brand END
  || CASE WHEN id % 11 <> 0 THEN ''
          WHEN id % 3 = 0 THEN '|' || part_name || '|nan'
          WHEN id % 3 = 1 THEN ';' || part_name || '; '
          ELSE ',' || part_name || ',N/A' END AS additional_tags,
  CASE id % 6
    WHEN 0 THEN 'Coaching_Poor_' || part_type
    WHEN 1 THEN 'Training_Good_' || part_type
    WHEN 2 THEN 'Coaching_Unclear_Pitch, Training_Clear_Recap'
    WHEN 3 THEN 'Fraud_Compliance_Review'
    WHEN 4 THEN 'audio_quality_personal_call'
    ELSE 'Rapport_' || brand END AS coaching_tags,
  CASE id % 6
    WHEN 0 THEN 'Contract_Sent'
    WHEN 1 THEN 'Access_Blocked'
    WHEN 2 THEN 'Try_Later'
    WHEN 3 THEN 'DM_Name_Secured'
    WHEN 4 THEN 'Callback_Scheduled; Email_Quote'
    ELSE 'FollowUp_Visit' END AS next_step,
  CASE id % 8
    WHEN 0 THEN 'Agent_Yelled_At_Customer'
    WHEN 1 THEN 'Customer insulted by agent'
    WHEN 2 THEN 'Client_Hung_Up_On_Advisor'
    WHEN 3 THEN 'decision maker refused rep offer'
    WHEN 4 THEN 'rep rejected business owner request'
    WHEN 5 THEN 'Caller_Agent_Threat'
    WHEN 6 THEN 'unclear answer'
    ELSE 'Warm_Lead' END AS descriptive_keywords,
  CASE id % 4
    WHEN 0 THEN 'Voicemail'
    WHEN 1 THEN 'Not_Interested'
    WHEN 2 THEN 'Interested'
    ELSE 'sale_closed' END AS outcome,
  CASE id % 4
    WHEN 0 THEN '["Info_Sent","Callback"]'
    WHEN 1 THEN '(' || chr(39) || 'Not_Received' || chr(39) || ', ' || chr(39) || 'Info_Sent' || chr(39) || ')'
    WHEN 2 THEN '[' || chr(39) || 'No_Answer' || chr(39) || ']'
    ELSE 'unknown' END AS outcome_sub
FROM (
  SELECT e.event_id AS id, 'call_' || e.event_id AS call_id, e.ts AS created_at,
    e.ts AS call_date_time, 'agent_' || e.user_id AS agent_name,
    1 + e.event_id % 2 AS sequence, e.event_type AS call_type,
    replace(p.p_name, ' ', '_') AS main_reason, p.p_name AS part_name,
    p.p_brand AS brand, p.p_type AS part_type, e.value AS duration
  FROM (SELECT *, event_id % (SELECT count(*) FROM {part}) AS pk FROM {events}) e
  JOIN {part} p ON p.p_partkey = e.pk
) c
"""

# Stage rows of the backfill: scalar, comma text and array text cells.
STAGE = """
SELECT o_orderkey AS id, 'call_' || o_orderkey AS call_id,
  o_orderpriority AS outcome,
  o_orderstatus || ', ' || o_orderpriority AS outcome_sub,
  CASE o_orderkey % 4
    WHEN 0 THEN chr(123) || o_orderstatus || ',' || chr(34) || o_orderpriority || chr(34) || chr(125)
    WHEN 1 THEN o_orderpriority || ' | ' || o_orderpriority || ';none'
    WHEN 2 THEN '["' || o_orderpriority || '", " ' || o_orderstatus || ' ", "null"]'
    ELSE NULL END AS additional_tags
FROM {orders}
"""

# One transcript line per conversation turn; joined in turn order by the reader.
HISTORY = """
SELECT CASE p_partkey % 3 WHEN 0 THEN 'main_reason' WHEN 1 THEN ' main_reason ' ELSE '' END AS field_name,
  CASE WHEN p_partkey % 3 = 2 THEN 'main_reason' END AS field,
  CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END AS label,
  CASE WHEN p_partkey % 2 = 1 THEN upper(p_name) END AS raw_label,
  CASE WHEN p_partkey % 5 = 0 THEN 'many' WHEN p_partkey % 5 = 1 THEN ''
       ELSE cast(p_size - 25 AS string) || '.0' END AS count,
  CASE WHEN p_partkey % 5 = 1 THEN cast(p_size AS string) END AS occurrences
FROM {part}
"""

# Mapper outputs: one per event, score and status from the number in its properties.
OUTPUTS = """
SELECT event_id, 'mapper_' || cast(cast(ts AS date) AS string) AS mapper_run_id,
  'calls' AS source_db, 'events' AS source_table,
  cast(user_id AS string) AS source_record_id, 'field_' || (user_id % 3) AS field_name,
  ts AS classified_at, ts AS created_at, k, 'Label_' || k AS raw_label,
  CASE WHEN k % 17 = 3 THEN '' ELSE 'label ' || k END AS normalized_label,
  k / 100.0 AS similarity_score,
  CASE WHEN k >= 82 THEN 'EXISTING_CLUSTER' WHEN k >= 72 THEN 'NEW_CLUSTER_CANDIDATE'
       WHEN k >= 62 THEN 'KNOWN_TRUE_ANOMALY' WHEN k >= 5 THEN 'TRUE_ANOMALY'
       ELSE 'NO_CLUSTER_REFERENCE' END AS mapping_status,
  CASE WHEN k >= 82 THEN 'centroid_similarity' WHEN k >= 72 THEN 'near_existing_below_threshold'
       WHEN k >= 62 THEN 'anomaly_centroid_similarity' WHEN k >= 5 THEN 'low_similarity_unresolved'
       ELSE 'no_active_cluster_reference' END AS mapping_method,
  CASE WHEN k >= 82 OR (k >= 62 AND k < 72) THEN 'base_' || (k % 10) END AS mapped_cluster_id,
  CASE WHEN k >= 82 OR (k >= 62 AND k < 72) THEN 'Display ' || (k % 10) END AS mapped_display_name,
  CASE WHEN k >= 5 THEN 'v1' END AS cluster_version
FROM (SELECT *, cast(regexp_extract(props, '[0-9]+', 0) AS bigint) AS k FROM {events}) e
"""

# Clustering runs: one per order status and month.
CLUSTER_RUNS = """
SELECT 'run_' || o_orderstatus || '_' || cast(ym AS string) AS run_id,
  'field_' || (ym % 3) AS field_name, 'v1' AS cluster_version,
  CASE WHEN ym % 2 = 0 THEN 'hash-384' END AS model_name, 'field_label' AS text_mode,
  cast(CASE WHEN ym % 4 <> 0 THEN count(*) END AS int) AS total_labels,
  cast(sum(cast(o_totalprice AS bigint)) AS bigint) AS total_occurrences,
  max(o_orderdate) AS created_at,
  count(*) AS n_total, count(*) / 4 AS n_quarter, ym
FROM (SELECT *, year(o_orderdate) * 100 + month(o_orderdate) AS ym FROM {orders}) o
GROUP BY o_orderstatus, ym
"""

# Backfill runs: one per day of events.
BACKFILL_RUNS = """
SELECT 'backfill_' || cast(d AS string) AS backfill_run_id, min(ts) AS started_at,
  CASE WHEN max(event_id) % 7 <> 0 THEN max(ts) END AS finished_at,
  CASE WHEN max(event_id) % 7 = 0 THEN 'RUNNING' WHEN max(event_id) % 5 = 0 THEN 'FAILED' ELSE 'DONE' END AS status,
  count(*) + 100 AS rows_pending, count(*) AS rows_scanned,
  sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS rows_changed,
  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS rows_unchanged,
  sum(CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END) AS rows_error
FROM (SELECT *, cast(ts AS date) AS d FROM {events}) e
GROUP BY d
"""

# Field audit of the backfill: one row per event.
FIELD_AUDIT = """
SELECT 'backfill_' || cast(cast(ts AS date) AS string) AS backfill_run_id, event_id AS stage_row_id,
  'field_' || (user_id % 3) AS field_name, event_type AS old_value,
  CASE event_id % 4 WHEN 0 THEN event_type ELSE 'Display ' || event_type END AS new_value,
  CASE event_id % 4 WHEN 0 THEN 'UNCHANGED' WHEN 1 THEN 'UNMAPPED' WHEN 2 THEN 'CHANGED' ELSE 'MAPPED' END AS field_status,
  value / 100.0 AS confidence, ts AS created_at
FROM {events}
"""

# Row audit of the backfill: one row per event.
ROW_AUDIT = """
SELECT event_id AS id, 'backfill_' || cast(cast(ts AS date) AS string) AS backfill_run_id,
  event_id AS stage_row_id, 'call_' || event_id AS call_id,
  CASE event_id % 4 WHEN 0 THEN 'UNCHANGED' ELSE 'UPDATED' END AS row_status, ts AS created_at
FROM {events}
"""

# Proposed cluster names with wrappers, hash tails, repeats and review suffixes.
PROPOSALS = """
SELECT p_partkey AS proposal_id,
  CASE p_partkey % 8
    WHEN 0 THEN '  ' || p_name || '  '
    WHEN 1 THEN chr(123) || p_name || ',' || p_type || chr(125)
    WHEN 2 THEN p_name || ' anomaly review 00' || (100 + p_partkey) || 'abc'
    WHEN 3 THEN replace(p_name, ' ', '_') || '-LOA/dm 3cx ' || p_type
    WHEN 4 THEN chr(34) || p_name || ' ' || p_name || ' vat HH 12ab' || chr(34)
    WHEN 5 THEN upper(p_type) || ' ' || p_type || chr(10) || p_name
    WHEN 6 THEN '(' || p_brand || ') FollowUp & more + than six words in here'
    ELSE '[]' END AS proposed
FROM {part}
"""

# Representative labels as JSON: strings, objects, an object with a list, broken text.
REPRESENTATIVES = """
SELECT p_partkey AS id,
  CASE p_partkey % 4
    WHEN 0 THEN '["' || p_name || '"," ' || p_type || ' ","' || p_name || '"]'
    WHEN 1 THEN '[' || chr(123) || '"raw_label":"' || p_name || '","n":1' || chr(125) || ',' || chr(123)
      || '"label":"","name":"' || p_brand || '"' || chr(125) || ',"' || p_type || '"]'
    WHEN 2 THEN chr(123) || '"labels":["' || p_name || '"," ","' || p_brand || '"]' || chr(125)
    ELSE p_name END AS reps
FROM {part}
"""
