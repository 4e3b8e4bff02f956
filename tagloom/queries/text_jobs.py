"""Queries over label texts and keys."""

from pyspark.sql import functions as F

from ..functions import text, vectors
from ..functions.lists import (
    ACRONYMS_BACKFILL, ACRONYMS_WEEKLY, GENERIC_NAMES, STOPWORDS, WEAK_MEDOIDS,
)
from ..operators import jobs, labels
from ..oracles import expr as X
from ..oracles.fixtures import _plain, with_tables
from ..registry import query
from ..sources.fixture_sql import PROPOSALS, REPRESENTATIVES

CALL_FIELDS = X.CALL_FIELDS


def facts(t):
    return labels.label_facts(t.calls(), CALL_FIELDS)


_raw = "raw_label"
_FORMS = f"""
  {X.norm_cluster(_raw)} AS norm_cluster, {X.norm_mapper(_raw)} AS norm_mapper,
  {X.norm_weekly(_raw)} AS norm_weekly, {X.norm_loose(_raw)} AS norm_loose,
  {X.norm_exact(_raw)} AS norm_exact,
  nullif(string_split({X.norm_cluster(_raw)}, ' ')[1], '') AS family,
  lower(trim({_raw})) NOT IN ('', 'nan', 'none', 'null') AS is_valid"""


@query(
    "normalize_table", "J1 C1 C2 C28 B3",
    with_tables(
        f"SELECT source, raw_label, n, {_FORMS} FROM raws", "fx_calls", "fx_stage", "fx_history",
        **X.call_label_steps(CALL_FIELDS),
        raws="""
          SELECT 'call' AS source, trim(item) AS raw_label, count(*) AS n FROM items GROUP BY ALL
          UNION ALL SELECT 'stage', additional_tags, count(*) FROM fx_stage
            WHERE additional_tags IS NOT NULL GROUP BY ALL
          UNION ALL SELECT 'history', coalesce(nullif(label, ''), '"' || raw_label || '"'), count(*)
            FROM fx_history GROUP BY ALL""",
    ),
)
def _(t):
    calls = t.calls()
    cells = F.flatten(F.array(*[text.split_label_items(F.col(c)) for c in CALL_FIELDS]))
    history = F.coalesce(
        F.nullif(F.col("label"), F.lit("")), F.concat(F.lit('"'), F.col("raw_label"), F.lit('"'))
    )
    raws = [
        ("call", calls.select(F.explode(cells).alias("raw_label"))),
        ("stage", t.stage().filter("additional_tags IS NOT NULL").select(
            F.col("additional_tags").alias("raw_label"))),
        ("history", t.history().select(history.alias("raw_label"))),
    ]
    counted = None
    for name, df in raws:
        part = df.groupBy("raw_label").agg(F.count("*").alias("n")).withColumn("source", F.lit(name))
        counted = part if counted is None else counted.unionByName(part)
    return jobs.normalize_table(counted)


@query(
    "cells_to_labels", "J2 C3 E1",
    with_tables(
        "SELECT id, field_name, pos - 1 AS item_no, raw_label, normalized_label FROM kept",
        "fx_calls",
        **X.call_labels(),
        kept="SELECT *, cast(row_number() OVER (PARTITION BY id, field_name ORDER BY pos) AS INT) AS p FROM call_labels",
    ).replace("pos - 1 AS item_no", "p - 1 AS item_no"),
)
def _(t):
    return labels.cells_to_labels(t.calls(), CALL_FIELDS, ["id"]).withColumnRenamed("pos", "item_no")


def stage_label_steps():
    invalid = X.quoted(["nan", "none", "null", "n/a", "na", "unknown"])

    def bare(x):
        return f"trim(trim({X.strip(x)}, '\"'), '''')"

    return {
        "stage_cells": """
          SELECT id, unnest(['outcome', 'outcome_sub', 'additional_tags']) AS field_name,
            unnest([outcome, outcome_sub, additional_tags]) AS cell FROM fx_stage""",
        "stage_items": rf"""
          SELECT id, field_name, unnest(l) AS raw_label, generate_subscripts(l, 1) AS pos FROM (
            SELECT *, CASE WHEN cell IS NULL OR lower(trim(cell)) IN ('', {invalid}) THEN []
              WHEN starts_with(cell, '[') THEN list_filter(list_transform(
                regexp_extract_all(cell, '"([^"]*)"', 1), lambda x: trim(x)),
                lambda x: lower(x) NOT IN ('', {invalid}))
              WHEN starts_with(cell, '{{') THEN list_filter(list_transform(
                string_split(cell[2:-2], ','), lambda x: {bare('x')}), lambda x: x <> '')
              WHEN field_name <> 'outcome' THEN list_filter(list_transform(
                regexp_split_to_array(cell, '\s*(?:,|;|\|)\s*'), lambda x: {bare('x')}),
                lambda x: lower(x) NOT IN ('', {invalid}))
              ELSE [trim(cell)] END AS l FROM stage_cells)""",
    }


@query(
    "stage_cells_to_labels", "J2 C4",
    with_tables(
        f"""SELECT id, field_name, cast(pos - 1 AS INT) AS item_no, raw_label,
          {X.norm_loose('raw_label')} AS normalized_label FROM stage_items""",
        "fx_stage", **stage_label_steps(),
    ),
)
def _(t):
    return labels.cells_to_labels(
        t.stage(), ["outcome", "outcome_sub", "additional_tags"], ["id"], rule="stage"
    ).withColumnRenamed("pos", "item_no")


@query(
    "discover_labels", "G24",
    with_tables(
        f"""SELECT field_name, raw_label, {X.norm_loose('raw_label')} AS normalized_label,
          count(*) AS label_count FROM stage_items
          WHERE {X.norm_loose('raw_label')} IS NOT NULL GROUP BY ALL""",
        "fx_stage", **stage_label_steps(),
    ),
)
def _(t):
    return labels.discover_labels(t.stage(), ["outcome", "outcome_sub", "additional_tags"])


@query("label_facts", "A4", with_tables("SELECT * FROM label_facts", "fx_calls", **X.label_facts()))
def _(t):
    return facts(t)


@query(
    "embedding_texts", "J3 C6 C7 C8",
    with_tables(
        f"""SELECT DISTINCT field_name, raw_label,
          {X.embedding_text('field_name', 'raw_label', X.norm_mapper('raw_label'))} AS text_mapper,
          {X.embedding_text('field_name', 'raw_label', f"coalesce({X.norm_loose('raw_label')}, '')")} AS text_backfill,
          {X.embedding_text('field_name', 'raw_label', X.norm_cluster('raw_label'), 'business_definition')} AS text_cluster
        FROM label_facts""",
        "fx_calls", **X.label_facts(),
    ),
)
def _(t):
    return jobs.embedding_texts(facts(t))


@query(
    "name_table", "J4 C9 C10 C11 C12 C13 C31",
    with_tables(
        f"""SELECT proposal_id, display_weekly, display_backfill, clean_weekly, clean_backfill, key, repeats,
          length(clean_weekly) <= 4 OR lower(clean_weekly) IN ({X.quoted(GENERIC_NAMES)}) AS is_generic,
          is_weak_medoid,
          CASE WHEN clean_weekly = '' THEN 'blank_name' ELSE concat_ws(',',
            CASE WHEN t.k IS NOT NULL THEN 'existing_name_conflict' END,
            CASE WHEN repeats THEN 'adjacent_repeated_words' END) END AS notes
        FROM (SELECT *, {X.name_key('clean_weekly')} AS key,
            len(list_filter(list_zip(string_split(lower(clean_weekly), ' ')[:-2], string_split(lower(clean_weekly), ' ')[2:]),
              lambda p: p[1] = p[2] AND p[1] <> '')) > 0 AS repeats FROM cleaned) c
        LEFT JOIN (SELECT DISTINCT {X.name_key('p_name')} AS k FROM part WHERE p_size > 40) t ON t.k = c.key""",
        p=_plain(PROPOSALS),
        cleaned=f"""SELECT proposal_id,
          {X.display_name(X.norm_weekly('proposed'), ACRONYMS_WEEKLY)} AS display_weekly,
          {X.display_name(f"coalesce({X.norm_loose('proposed')}, '')", ACRONYMS_BACKFILL)} AS display_backfill,
          {X.sanitize('proposed', ACRONYMS_WEEKLY)} AS clean_weekly,
          {X.sanitize('proposed', ACRONYMS_BACKFILL)} AS clean_backfill,
          lower({X.strip('proposed')}) IN ({X.quoted(WEAK_MEDOIDS)}) OR length({X.strip('proposed')}) <= 2
            OR regexp_full_match({X.strip('proposed')}, '\\d+(\\.\\d+)?') AS is_weak_medoid
          FROM p""",
    ),
)
def _(t):
    taken = t.given("part").filter("p_size > 40").select(F.col("p_name").alias("display_name"))
    return (
        jobs.name_table(t.proposals(), taken)
        .withColumn("notes", F.array_join("notes", ","))
        .drop("proposed")
    )


@query(
    "relation_table", "C14 C16",
    with_tables(
        f"""SELECT f.field_name, f.raw_label, f.value_count, m.mask AS actor_mask,
          {X.opposite_mask("m.norm")} AS opposite_mask,
          coalesce((SELECT string_agg(DISTINCT w, ' ' ORDER BY w)
            FROM (SELECT unnest(string_split({X.norm_weekly('f.raw_label')}, ' ')) AS w)
            WHERE length(w) > 1 AND w NOT IN ({X.quoted(STOPWORDS)})), '') AS tokens
        FROM label_facts f JOIN a_mask m ON m.norm = {X.norm_mapper('f.raw_label')}""",
        "fx_calls", **X.label_facts(), **X.actor_steps("label_facts", X.norm_mapper("raw_label"), "a"),
    ),
)
def _(t):
    return (
        jobs.relation_table(facts(t))
        .withColumn("tokens", F.array_join(F.array_sort("tokens"), " "))
        .drop("relations")
    )


@query(
    "guard_pairs", "J5 C15 C17",
    with_tables(
        f"""SELECT a.field_name, a.raw_label, 'c_' || b.n AS cluster_id,
          {X.swap_hit('a.opp', 'b.opp', 10)} AS contradiction, {X.swap_hit('a.act', 'b.act', 3)} AS actor_conflict
        FROM masked a JOIN masked b USING (field_name)
        WHERE {X.swap_hit('a.opp', 'b.opp', 10)} OR {X.swap_hit('a.act', 'b.act', 3)}""",
        "fx_calls", **X.label_facts(), **X.actor_steps("label_facts", X.norm_mapper("raw_label"), "a"),
        masked=f"""SELECT f.field_name, f.raw_label, m.norm AS n, m.mask AS act,
          {X.opposite_mask('m.norm')} AS opp
          FROM label_facts f JOIN a_mask m ON m.norm = {X.norm_mapper('f.raw_label')}""",
    ),
)
def _(t):
    f = facts(t)
    clusters = f.select(
        "field_name",
        F.concat(F.lit("c_"), text.normalize_label(F.col("raw_label"), "mapper")).alias("cluster_id"),
        F.col("raw_label").alias("cluster_text"),
    )
    return jobs.guard_pairs(f, clusters)


@query(
    "key_table", "J6 C18 C19 C20 C29",
    with_tables(
        """SELECT event_id, sha256(p) AS dedupe_key, md5(p) AS old_key,
          'weekly_anom_' || left(sha256(field_name || '||' || normalized_label), 18) AS cluster_id,
          left(sha256(mapper_run_id), 8) AS run_hash,
          'generated_' || left(sha256('{"event_id":' || event_id || ',"field_name":"' || field_name
            || '","raw_label":"' || raw_label || '"}'), 24) AS record_id,
          field_name || '_sbert_mini-lm_field_label' AS cache_key
        FROM (SELECT *, source_db || '|' || source_table || '|' || source_record_id || '|' || field_name || '|'
          || normalized_label || '|' || coalesce(cluster_version, '') AS p FROM fx_outputs)""",
        "fx_outputs",
    ),
)
def _(t):
    return jobs.key_table(t.outputs(), "sbert/mini-lm")


@query(
    "typed_vectors", "J7 C22",
    """WITH r AS (SELECT vec_id, vec_id % 5 AS i, embedding::DOUBLE[] AS e FROM embeddings)
    SELECT vec_id, CASE WHEN i < 2 THEN len(e) END AS n_raw,
      CASE WHEN i < 2 THEN round(list_sum(e) / sqrt(list_inner_product(e, e)), 6) END AS unit_sum,
      CASE WHEN i = 0 THEN len(e) END AS n_drop,
      CASE WHEN i = 3 THEN 'empty' WHEN i IN (2, 4) THEN 'not a finite vector' END AS reject FROM r""",
)
def _(t):
    total = F.aggregate("unit", F.lit(0.0), lambda a, x: a + x)
    return jobs.typed_vectors(t.vector_texts()).select(
        "vec_id",
        F.size("raw").cast("bigint").alias("n_raw"),
        F.round(total, 6).alias("unit_sum"),
        F.size("drop").cast("bigint").alias("n_drop"),
        "reject",
    )


@query(
    "representative_labels", "J7 C23",
    with_tables(
        """SELECT r.id, CASE p_partkey % 4 WHEN 0 THEN p_name || '~' || p_type WHEN 1 THEN p_name || '~' || p_brand || '~' || p_type
          WHEN 2 THEN p_name || '~' || p_brand ELSE '' END AS labels FROM r JOIN part ON p_partkey = r.id""",
        r=_plain(REPRESENTATIVES),
    ),
)
def _(t):
    found = vectors.representatives(F.col("reps"))
    return t.representative_texts().select("id", F.array_join(found, "~").alias("labels"))


@query(
    "call_times_and_metadata", "J7 C21 C30",
    with_tables(
        """SELECT id, created_at + INTERVAL 0 SECOND AS ts,
          '{"call_id":"' || call_id || '","agent_name":"' || agent_name || '","created_at":"'
            || strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') || '","sequence":' || sequence || '}' AS source_metadata
        FROM fx_calls""",
        "fx_calls",
    ).replace("created_at + INTERVAL 0 SECOND AS ts", "strftime(created_at, '%Y-%m-%d %H:%M:%S') AS ts"),
)
def _(t):
    from ..functions.keys import to_utc

    calls = t.calls()
    as_text = F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return calls.select(
        "id",
        F.date_format(to_utc(as_text), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        labels.source_metadata(
            calls, ["call_id", "agent_name", "no_such_column", "created_at", "sequence"]
        ).alias("source_metadata"),
    )


@query(
    "parse_call_labels", "C26 C5 C32",
    with_tables(
        r"""SELECT id, coalesce(array_to_string(CASE WHEN starts_with(additional_tags, '{')
            THEN list_transform(string_split(additional_tags[2:-2], ','), lambda x: regexp_replace(trim(x), '^"(.*)"$', '\1'))
            ELSE [additional_tags] END, '~'), '') AS call_values,
          coalesce(starts_with(additional_tags, '{'), false) AS is_multi,
          CASE WHEN additional_tags IS NOT NULL THEN o END AS rebuilt,
          trim(coalesce(additional_tags, '')) <> trim(coalesce(o, '')) AS changed
        FROM fx_stage LEFT JOIN (SELECT id, string_agg(raw_label, ', ' ORDER BY pos) AS o FROM stage_items
          WHERE field_name = 'additional_tags' GROUP BY id) USING (id)""",
        "fx_stage", **stage_label_steps(),
    ),
)
def _(t):
    c = F.col("additional_tags")
    parsed = text.parse_call_label(c)
    items = text.parse_stage_labels(c, True)
    rebuilt = text.assemble_stage_value(c, items, True)
    return t.stage().select(
        "id",
        F.coalesce(F.array_join(parsed["values"], "~"), F.lit("")).alias("call_values"),
        F.coalesce(parsed["is_multi"], F.lit(False)).alias("is_multi"),
        rebuilt.alias("rebuilt"),
        text.row_changed(c, rebuilt).alias("changed"),
    )


@query(
    "search_documents", "J8 C24 C25",
    with_tables(
        """SELECT m.field_name, m.raw_label, c.id AS cluster_db_id,
          concat_ws(' | ', replace(m.raw_label, '_', ' '),
            CASE WHEN m.normalized_label <> replace(m.raw_label, '_', ' ') THEN m.normalized_label END,
            n.display_name,
            CASE WHEN replace(c.medoid_label, '_', ' ') NOT IN (replace(m.raw_label, '_', ' '), m.normalized_label)
              THEN replace(c.medoid_label, '_', ' ') END,
            replace(m.field_name, '_', ' ')) AS search_text
        FROM fx_label_map m
        LEFT JOIN fx_clusters c ON c.field_name = m.field_name AND c.cluster_id = m.final_cluster_id
          AND c.cluster_version = m.cluster_version AND c.active
        LEFT JOIN fx_names n ON n.field_name = m.field_name AND n.cluster_id = m.final_cluster_id
          AND n.cluster_version = m.cluster_version""",
        "fx_label_map", "fx_clusters", "fx_names",
    ),
)
def _(t):
    docs = jobs.search_documents(t.label_map(), t.clusters(), t.names())
    return docs.select(
        "field_name", "raw_label", "cluster_db_id", text.fix_query(F.col("search_text")).alias("search_text")
    )


@query(
    "band_table", "J9 C27 C32",
    with_tables(
        """SELECT event_id,
          CASE WHEN mapping_status = 'KNOWN_TRUE_ANOMALY' AND k >= 82 THEN 'anomaly recovery candidate'
            WHEN mapped_cluster_id IS NOT NULL AND k >= 90 THEN 'merge candidate'
            WHEN k >= 82 THEN 'semantic neighbor' WHEN k >= 72 THEN 'weak semantic neighbor'
            ELSE 'distant neighborhood' END AS similarity_band,
          CASE WHEN k >= 75 THEN 'confident' WHEN k >= 60 THEN 'possible' ELSE 'weak' END AS search_confidence,
          CASE WHEN k >= 55 THEN 'Confident' WHEN k >= 30 THEN 'Possible' ELSE 'Weak' END AS label_confidence,
          true AS changed FROM fx_outputs""",
        "fx_outputs",
    ),
)
def _(t):
    return jobs.band_table(t.outputs()).select(
        "event_id", "similarity_band", "search_confidence", "label_confidence", "changed"
    )


SIZE_BUCKET = """CASE WHEN cluster_size = 1 THEN '1' WHEN cluster_size <= 3 THEN '2–3' WHEN cluster_size <= 5 THEN '4–5'
  WHEN cluster_size <= 10 THEN '6–10' WHEN cluster_size <= 25 THEN '11–25' WHEN cluster_size <= 50 THEN '26–50'
  WHEN cluster_size <= 100 THEN '51–100' ELSE '100+' END"""
ANOMALY_TYPE = """CASE WHEN cluster_size <= 2 THEN 'noise' WHEN cluster_size <= 5 THEN 'threshold_failure'
  WHEN cluster_size > 20 THEN 'emerging' ELSE 'semantic_outlier' END"""


@query(
    "size_band_table", "J9 C27",
    with_tables(
        f"SELECT id, cluster_size, {SIZE_BUCKET} AS bucket, {ANOMALY_TYPE} AS anomaly_type FROM fx_clusters",
        "fx_clusters",
    ),
)
def _(t):
    return jobs.size_band_table(t.clusters()).select("id", "cluster_size", "bucket", "anomaly_type")
