"""The derived tables as CTEs for the SQL checks."""

from __future__ import annotations

import string

from ..sources import fixture_sql as fx

_GIVEN = {n: n for n in ("events", "part", "orders")}


def _plain(text: str) -> str:
    return text.format(**{f: f for _, f, _, _ in string.Formatter().parse(text) if f})


def unit(v: str) -> str:
    return (
        f"CASE WHEN list_inner_product({v}, {v}) > 0 THEN "
        f"list_transform({v}, lambda x: x / sqrt(list_inner_product({v}, {v}))) ELSE {v} END"
    )


def days_after(n: str) -> str:
    return f"make_timestamp(1704067200000000 + cast({n} AS BIGINT) * 86400000000)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_calls": ((), _plain(fx.CALLS)),
    "fx_stage": ((), _plain(fx.STAGE)),
    "fx_history": ((), _plain(fx.HISTORY)),
    "fx_outputs": ((), _plain(fx.OUTPUTS)),
    "fx_candidates": (
        ("fx_outputs",),
        """
        SELECT o.*, j, 'base_' || ((k + j) % 10) AS cand_id,
          cast((k - j * 2) / 100.0 AS DOUBLE) AS cand_score,
          'Display ' || ((k + j) % 10) AS cand_display, 'Label_' || (k - k % 2) AS cand_medoid,
          0.82::DOUBLE AS cand_threshold
        FROM fx_outputs o, (SELECT unnest(range(5)) AS j) js WHERE j = 0 OR k % 5 <> 0""",
    ),
    "fx_transcripts": (
        (),
        """
        SELECT 'call_' || conv_id AS call_id, string_agg(text, ' ' ORDER BY turn, role, text) AS transcript
        FROM conversations GROUP BY conv_id""",
    ),
    "fx_cluster_runs": (
        (),
        "SELECT * EXCLUDE (n_total, n_quarter), n_total, cast(floor(n_quarter) AS BIGINT) AS n_quarter FROM ("
        + _plain(fx.CLUSTER_RUNS)
        + ")",
    ),
    "fx_backfill_runs": ((), _plain(fx.BACKFILL_RUNS)),
    "fx_field_audit": ((), _plain(fx.FIELD_AUDIT)),
    "fx_row_audit": ((), _plain(fx.ROW_AUDIT)),
    "fx_queue": (
        ("fx_outputs",),
        """
        SELECT * EXCLUDE (k),
          CASE k % 4 WHEN 0 THEN 'MAP_TO_EXISTING' WHEN 1 THEN 'ANOMALY'
            WHEN 2 THEN 'PROMOTE' END AS resolver_status,
          CASE WHEN k % 4 <> 3 THEN k % 3 = 0 END AS materialized
        FROM (
          SELECT field_name, normalized_label, k, count(*) AS occurrence_count,
            count(DISTINCT source_record_id) AS distinct_call_count,
            min(classified_at) AS first_seen, max(classified_at) AS last_seen
          FROM fx_outputs
          WHERE mapping_status IN ('TRUE_ANOMALY', 'NEW_CLUSTER_CANDIDATE') AND normalized_label <> ''
          GROUP BY field_name, normalized_label, k)""",
    ),
    "fx_raw_vectors": (
        (),
        """
        SELECT vec_id, label, vec_id % 3 AS f, embedding::DOUBLE[] AS e,
          CASE (vec_id // 3) % 4 WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.8::DOUBLE
            WHEN 2 THEN 0.55::DOUBLE ELSE 0.3::DOUBLE END AS w
        FROM embeddings""",
    ),
    "fx_blend": (
        ("fx_raw_vectors",),
        """
        SELECT r.*, list_transform(range(1, len(e) + 1), lambda i: w * a[i] + (1 - w) * e[i]) AS b
        FROM fx_raw_vectors r
        JOIN (SELECT f, label, arg_min(e, vec_id) AS a FROM fx_raw_vectors GROUP BY f, label) an
          USING (f, label)""",
    ),
    "fx_label_vectors": (
        ("fx_blend",),
        f"""
        SELECT vec_id, 'field_' || f AS field_name, 'Label_' || vec_id AS raw_label,
          'label ' || vec_id AS normalized_label, 1 + vec_id % 7 AS value_count,
          'base_' || label AS cluster_id, label * 3 + f AS idx, w, {unit('b')} AS v
        FROM fx_blend""",
    ),
    "fx_means": (
        ("fx_label_vectors",),
        f"""
        SELECT field_name, cluster_id, idx, {unit('mean')} AS c FROM (
          SELECT field_name, cluster_id, idx, list(m ORDER BY pos) AS mean FROM (
            SELECT field_name, cluster_id, idx, pos,
              sum(value_count * x) / sum(value_count) AS m
            FROM (SELECT field_name, cluster_id, idx, value_count, unnest(v) AS x,
                    generate_subscripts(v, 1) AS pos FROM fx_label_vectors WHERE w >= 0.8)
            GROUP BY field_name, cluster_id, idx, pos)
          GROUP BY field_name, cluster_id, idx)""",
    ),
    "fx_clusters": (
        ("fx_means",),
        f"""
        SELECT cast(idx AS BIGINT) AS id, 'run_' || field_name AS run_id, field_name, cluster_id,
          CASE WHEN idx % 6 <> 5 THEN 'v1' END AS cluster_version,
          CASE WHEN idx % 7 = 3 THEN 'true_anomaly' WHEN idx % 4 = 2 THEN 'strict_graph_recovery'
            ELSE 'base_hdbscan' END AS cluster_source,
          CASE WHEN idx % 11 <> 4 THEN c END AS centroid_embedding,
          cast(n AS INT) AS cluster_size, total_occurrences,
          CASE WHEN idx % 5 = 4 THEN 'Misc' ELSE medoid END AS medoid_label,
          CASE WHEN idx % 5 <> 4 THEN sim END AS medoid_similarity_to_centroid,
          CASE WHEN idx % 7 = 3 THEN true WHEN idx % 2 = 0 THEN false END AS is_true_anomaly_cluster,
          CASE WHEN idx % 5 <> 2 THEN 0.82::DOUBLE END AS similarity_threshold,
          CASE WHEN idx % 13 = 6 THEN false WHEN idx % 4 <> 1 THEN true END AS active,
          CASE WHEN idx % 3 = 1 THEN 'Own Name ' || idx END AS display_name,
          CASE WHEN idx % 7 = 3 THEN 'ACTIVE_TRUE_ANOMALY' END AS promotion_status,
          {days_after('idx')} AS created_at, {days_after('idx * 2')} AS updated_at
        FROM (
          SELECT field_name, cluster_id, idx, any_value(c) AS c, count(*) AS n,
            cast(sum(value_count) AS BIGINT) AS total_occurrences, max(sim) AS sim,
            first(raw_label ORDER BY sim DESC, raw_label) AS medoid
          FROM (SELECT l.*, m.c, round(list_cosine_similarity(v, c), 9) AS sim
                FROM fx_label_vectors l JOIN fx_means m USING (field_name, cluster_id, idx)
                WHERE w >= 0.8)
          GROUP BY field_name, cluster_id, idx)""",
    ),
    "fx_names": (
        ("fx_label_vectors",),
        f"""
        SELECT field_name, cluster_id, 'run_' || field_name AS run_id,
          CASE WHEN idx % 6 <> 5 THEN 'v1' END AS cluster_version,
          CASE WHEN idx % 10 = 0 THEN 'Other' WHEN idx % 10 = 7 THEN 'Misc'
            WHEN idx % 8 = 5 THEN 'Shared Name' ELSE 'Cluster Name ' || idx END AS display_name,
          'deterministic' AS naming_method, idx % 7 = 3 AS is_anomaly, true AS active,
          {days_after('idx')} AS created_at, {days_after('idx')} AS updated_at
        FROM (SELECT DISTINCT field_name, cluster_id, idx FROM fx_label_vectors WHERE w >= 0.8)
        WHERE idx % 9 <> 7""",
    ),
    "fx_label_map": (
        ("fx_label_vectors",),
        """
        SELECT 'run_' || field_name AS run_id, field_name, raw_label, normalized_label, value_count,
          cluster_id AS final_cluster_id,
          CASE WHEN w >= 0.8 THEN 'base_hdbscan' WHEN w >= 0.5 THEN 'strict_graph_recovery'
            ELSE 'true_anomaly' END AS final_cluster_source,
          w < 0.5 AS final_is_true_anomaly,
          CASE WHEN w >= 0.8 THEN replace(cluster_id, 'base_', '') ELSE '-1' END AS base_cluster_id,
          CASE WHEN idx % 6 <> 5 THEN 'v1' END AS cluster_version
        FROM fx_label_vectors""",
    ),
    "fx_coordinates": (
        (),
        f"""
        SELECT 'field_' || (vec_id % 3) AS field_name, 'base_' || label AS cluster_id,
          CASE WHEN vec_id % 2 = 0 THEN 'pca' ELSE 'random' END AS projection_method,
          'run_' || (vec_id % 5) AS run_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y,
          embedding[3]::DOUBLE AS z, {days_after('vec_id')} AS created_at
        FROM embeddings""",
    ),
}


def expand(names: list[str], extra: dict[str, tuple[tuple[str, ...], str]]) -> list[str]:
    """CTE names with their dependencies, each once, in order of definition."""
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in seen:
            return
        for dep in {**CTES, **extra}[name][0]:
            visit(dep)
        seen.append(name)

    for n in names:
        visit(n)
    return seen


def with_tables(sql: str, *names: str, **ctes: str) -> str:
    """Prefix a SELECT with the CTEs it uses; ``ctes`` are further named steps, in order."""
    order = expand(list(names), {})
    parts = [f"{n} AS ({CTES[n][1]})" for n in order]
    parts += [f"{n} AS ({text})" for n, text in ctes.items()]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
