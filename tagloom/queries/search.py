"""Queries over search, evidence and layouts."""

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..lineage import checkpoint_dir, cut
from ..operators import layout as L
from ..operators import search as S
from ..operators import jobs
from ..operators.reports import latest_projection
from ..operators.vector_index import temporary_index
from ..registry import ENTRIES, query
from .operations import LATEST
from .reports import SPOTS, STATE, STRICT, reg, ts, ts_sql
from .vectors import r6


def query_vector(t, text="label 7"):
    """The vector of one label, as one row."""
    return t.label_vectors().filter("vec_id = 7").select(F.col("v").alias("q"), F.lit(text).alias("query_text"))


@reg(
    "similar_clusters", "E9 C27",
    f"""SELECT *, round(avg(cosine_similarity) OVER (), 4) AS mean_similarity FROM (
      SELECT c.id, round(cos, 4) AS cosine_similarity, c.field_name = o.field_name AS same_field,
        CASE WHEN o.a AND cos >= 0.82 THEN 'anomaly recovery candidate' WHEN c.field_name = o.field_name AND cos >= 0.9 THEN 'merge candidate'
          WHEN cos >= 0.82 THEN 'semantic neighbor' WHEN cos >= 0.72 THEN 'weak semantic neighbor' ELSE 'distant neighborhood' END AS interpretation
      FROM (SELECT *, list_cosine_similarity(centroid_embedding, (SELECT centroid_embedding FROM fx_clusters WHERE id = 3)) AS cos FROM fx_clusters) c,
        (SELECT field_name, coalesce(is_true_anomaly_cluster, false) AS a FROM fx_clusters WHERE id = 3) o
      WHERE c.id <> 3 AND centroid_embedding IS NOT NULL ORDER BY round(cos, 4) DESC, c.id LIMIT 8)""",
    "fx_clusters",
)
def _(t):
    out = S.similar_clusters(t.clusters(), t.names(), 3)
    return out.select("id", "cosine_similarity", "same_field", "interpretation", "mean_similarity")


def hits_of(t):
    """Distinct output labels as hits; some with another raw spelling."""
    raw = F.when(F.col("k") % 2 == 0, F.col("raw_label")).otherwise(F.upper("raw_label"))
    return t.outputs().select(
        F.concat_ws("|", "field_name", "raw_label").alias("hit_id"), "field_name", raw.alias("raw_label"),
        "normalized_label", (F.col("k") / 100).alias("similarity"),
    ).distinct()


@reg(
    "label_hits_to_map", "E10",
    """SELECT DISTINCT h.hit_id, h.field_name, m.raw_label AS map_raw, m.final_cluster_id FROM (
      SELECT DISTINCT field_name || '|' || raw_label AS hit_id, field_name, CASE WHEN k % 2 = 0 THEN raw_label ELSE upper(raw_label) END AS raw_label,
        normalized_label FROM fx_outputs) h
    JOIN fx_label_map m ON m.field_name = h.field_name AND (m.raw_label = h.raw_label OR m.normalized_label = h.normalized_label)""",
    "fx_outputs", "fx_label_map",
)
def _(t):
    return S.label_hits_to_map(hits_of(t), t.label_map()).select("hit_id", "field_name", "map_raw", "final_cluster_id")


@reg(
    "call_samples", "E11",
    f"""SELECT c.id, s.n AS production_rows, s.d AS distinct_call_count, s.t AS latest_classified_at, s.ids AS sample_call_ids
    FROM fx_clusters c LEFT JOIN (SELECT field_name, mapped_cluster_id, count(*) AS n, count(DISTINCT source_record_id) AS d,
        {ts_sql('max(classified_at)')} AS t,
        array_to_string(list(source_record_id ORDER BY classified_at DESC, source_record_id)[1:4], ',') AS ids
      FROM run WHERE mapping_status = 'EXISTING_CLUSTER' GROUP BY ALL) s ON s.field_name = c.field_name AND s.mapped_cluster_id = c.cluster_id""",
    "fx_clusters", "fx_outputs", run=LATEST,
)
def _(t):
    out = S.call_samples(t.clusters().select("id", "field_name", "cluster_id"), t.outputs(), n=4)
    return ts(out, "latest_classified_at").select(
        "id", "production_rows", "distinct_call_count", "latest_classified_at",
        F.array_join("sample_call_ids", ",").alias("sample_call_ids"),
    )


@reg(
    "call_evidence", "E12",
    f"""SELECT c.call_id, {ts_sql('c.call_date_time')} AS at, c.agent_name, substr(t.transcript, 1, 400) AS transcript_preview,
      t.transcript IS NOT NULL AND length(t.transcript) > 400 AS full_transcript_available
    FROM (SELECT * FROM fx_calls WHERE outcome = 'Voicemail' AND sequence = 1 ORDER BY call_date_time DESC, call_id LIMIT 100) c
    LEFT JOIN fx_transcripts t USING (call_id)""",
    "fx_calls", "fx_transcripts",
)
def _(t):
    out = S.call_evidence(t.calls(), t.transcripts(), "outcome", '{"Voicemail"}', 100)
    return out.select(
        "call_id", F.date_format("call_date_time", "yyyy-MM-dd HH:mm:ss").alias("at"), "agent_name",
        "transcript_preview", "full_transcript_available",
    )


@reg(
    "call_evidence_tags", "E12",
    """SELECT call_id, agent_name FROM (SELECT id, call_id, call_date_time, agent_name, list_transform(string_split(
        replace(replace(additional_tags, ';', '|'), ',', '|'), '|'), lambda x: trim(x)) AS tags FROM fx_calls WHERE sequence = 1)
    WHERE list_contains(tags, 'click') AND list_contains(tags, 'small ring') ORDER BY call_date_time DESC, call_id LIMIT 25""",
    "fx_calls",
)
def _(t):
    tags = F.transform(F.split("additional_tags", "[|;,]"), lambda x: F.trim(x))
    calls = t.calls().withColumn("additional_tags", tags)
    return S.call_evidence(calls, t.transcripts(), "additional_tags", '{click,"small ring"}').select("call_id", "agent_name")


HIT_STEPS = {
    "strict": STRICT,
    "hits": """SELECT field_name, raw_label, normalized_label, round(list_cosine_similarity(v, (SELECT v FROM fx_label_vectors WHERE vec_id = 7)), 9) AS similarity
      FROM fx_label_vectors WHERE similarity >= 0.34""",
    "mapped": """SELECT DISTINCT h.field_name, h.similarity, m.raw_label, m.run_id, m.final_cluster_id AS cluster_id, m.value_count
      FROM hits h JOIN fx_label_map m ON m.field_name = h.field_name AND (m.raw_label = h.raw_label OR m.normalized_label = h.normalized_label)""",
}


@reg(
    "semantic_search", "H23 E10",
    """SELECT id, round(best * 0.78 + mean * 0.22, 4) AS semantic_score, n AS matched_label_count, occ AS matched_occurrences, best_label,
      labels, name FROM (SELECT field_name, run_id, cluster_id, max(similarity) AS best, avg(similarity) AS mean, count(*) AS n,
        cast(sum(value_count) AS BIGINT) AS occ, first(raw_label ORDER BY similarity DESC, value_count DESC, raw_label) AS best_label,
        array_to_string(list(raw_label ORDER BY similarity DESC, value_count DESC, raw_label)[1:8], ',') AS labels FROM mapped GROUP BY ALL) h
    JOIN strict c USING (field_name, run_id, cluster_id) WHERE coalesce(active, true) AND best * 0.78 + mean * 0.22 >= 0.34
    ORDER BY semantic_score DESC, best DESC, total_occurrences DESC, id LIMIT 60""",
    *STATE, **HIT_STEPS,
)
def _(t):
    out = S.semantic_search(query_vector(t), t.label_embeddings(), t.label_map(), t.clusters(), t.names())
    return out.select(
        "id", "semantic_score", "matched_label_count", "matched_occurrences", "best_label",
        F.array_join("matched_labels.raw_label", ",").alias("labels"), "name",
    )


@reg(
    "reranked_search", "H24",
    """SELECT field_name, cluster_id, cluster_version, round(max(s), 4) AS semantic_score, count(*) AS matched_label_count,
      cast(sum(value_count) AS BIGINT) AS matched_occurrences, first(raw_label ORDER BY s DESC, r DESC, raw_label) AS semantic_best_label FROM (
        SELECT m.field_name, m.final_cluster_id AS cluster_id, m.cluster_version, m.raw_label, m.value_count, r,
          round(((CASE WHEN contains(m.field_name || ' ' || m.raw_label, '') THEN 1 ELSE 0 END)
            + CASE WHEN list_contains(string_split(m.normalized_label || ' ' || replace(coalesce(c.medoid_label, ''), '_', ' '), ' '), '7') THEN 1 ELSE 0 END) / 2, 6) AS s
        FROM (SELECT field_name, raw_label, round(list_inner_product(v, (SELECT v FROM fx_label_vectors WHERE vec_id = 7)), 9) AS r
          FROM fx_label_vectors ORDER BY r DESC, field_name, raw_label LIMIT 200) h
        JOIN fx_label_map m USING (field_name, raw_label)
        LEFT JOIN fx_clusters c ON c.field_name = m.field_name AND c.cluster_id = m.final_cluster_id AND c.cluster_version = m.cluster_version AND c.active)
    WHERE cluster_version IS NOT NULL GROUP BY ALL""",
    *STATE,
)
def _(t):
    docs = jobs.search_documents(t.label_map(), t.clusters(), t.names()).drop("medoid_label")
    docs = docs.join(t.label_embeddings().select("field_name", "raw_label", "embedding"), ["field_name", "raw_label"])
    out = S.reranked_search(query_vector(t), docs, t.clusters(), limit=1000)
    return out.filter("cluster_version IS NOT NULL").select(
        "field_name", "cluster_id", "cluster_version", "semantic_score", "matched_label_count", "matched_occurrences",
        "semantic_best_label",
    )


def label_index(t, rows):
    """An index of two thirds of the rows, to which the others are added."""
    rows = cut(rows.withColumn("label_id", F.concat_ws("|", "field_name", "raw_label")))
    late = F.pmod(F.xxhash64("label_id"), F.lit(3)) == 0
    index = temporary_index(rows.filter(~late), checkpoint_dir(t.spark), "label_id", "embedding")
    index.insert(rows.filter(late), "label_id", "embedding")
    return index


@query("indexed_search", "H23 E10", ENTRIES["semantic_search"].sql)
def _(t):
    """The same search over an index of the vectors."""
    out = S.semantic_search(query_vector(t), label_index(t, t.label_embeddings()), t.label_map(), t.clusters(), t.names())
    return out.select(
        "id", "semantic_score", "matched_label_count", "matched_occurrences", "best_label",
        F.array_join("matched_labels.raw_label", ",").alias("labels"), "name",
    )


@reg(
    "indexed_top_k", "H23 H24 E6",
    """SELECT id, raw_label, rank FROM (SELECT c.id, l.field_name || '|' || l.raw_label AS raw_label, cast(row_number() OVER (PARTITION BY c.id
        ORDER BY round(list_cosine_similarity(c.centroid_embedding, l.v), 9) DESC, l.field_name || '|' || l.raw_label) AS INT) AS rank
      FROM fx_clusters c JOIN fx_label_vectors l ON len(l.v) = len(c.centroid_embedding)) WHERE rank <= 5""",
    "fx_clusters", "fx_label_vectors",
)
def _(t):
    """The five labels nearest to every cluster, over all fields, in one search of the index."""
    asked = t.clusters().filter("centroid_embedding IS NOT NULL").select(F.col("id").cast("string").alias("q"), F.col("centroid_embedding").alias("x"))
    found = label_index(t, t.label_embeddings()).search(asked, "q", "x", k=5)
    return found.select(F.col("q_id").cast("bigint").alias("id"), F.col("row.label_id").alias("raw_label"), "rank")


# Layout ------------------------------------------------------------------------------------


@reg(
    "load_centroids", "V1",
    """SELECT id, run_id, len(centroid_embedding) AS dim FROM fx_clusters WHERE coalesce(active, true) AND centroid_embedding IS NOT NULL""",
    "fx_clusters",
)
def _(t):
    return L.load_centroids(t.clusters()).select("id", "run_id", F.size("v").cast("bigint").alias("dim"))


@reg("pca3", "V2", "", "fx_clusters")
def _(t):
    out = L.pca3(t.label_vectors().select("vec_id", "v"))
    return out.select("vec_id", *[r6(c).alias(c) for c in "xyz"])


def _wave_sql(step, start):
    x = f"sin((i - 1) * {step} + {start} + 1) * 10000"
    return f"(({x} - floor({x})) * 2 - 1)"


@reg(
    "random_projection3", "V3",
    f"""SELECT vec_id, round(list_sum(list_transform(e, lambda v, i: v * {_wave_sql(17, 3)})) / n * 52, 5) AS x,
      round(list_sum(list_transform(e, lambda v, i: v * {_wave_sql(29, 5)})) / n * 52 * 0.72, 5) AS y,
      round(list_sum(list_transform(e, lambda v, i: v * {_wave_sql(43, 7)})) / n * 52, 5) AS z
    FROM (SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n FROM embeddings)""",
)
def _(t):
    df = t.given("embeddings").select("vec_id", V.as_double(F.col("embedding")).alias("v"))
    return L.random_projection3(df).select("vec_id", *[F.round(c, 5).alias(c) for c in "xyz"])


PLACED = {"spots": SPOTS, "p": "SELECT * FROM spots WHERE projection_method = 'pca'"}


@reg(
    "scale_layout", "V4",
    """SELECT field_name, cluster_id, round((x - cx) * 150 / span, 6) AS pos_x, round((y - cy) * 150 / span, 6) AS pos_y,
      round((z - cz) * 150 / span, 6) AS pos_z, round(least(1, ln(1 + cluster_size) / ln(1 + ms)), 6) AS size_ratio,
      round(least(1, ln(1 + total_occurrences) / ln(1 + mo)), 6) AS occurrence_ratio
    FROM p JOIN fx_clusters USING (field_name, cluster_id), (SELECT (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy, (min(z) + max(z)) / 2 AS cz,
      greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z), 1e-6) AS span FROM p),
      (SELECT max(cluster_size) AS ms, max(total_occurrences) AS mo FROM fx_clusters)""",
    "fx_coordinates", "fx_clusters", **PLACED,
)
def _(t):
    out = L.scale_layout(latest_projection(t.coordinates(), "pca"), t.clusters())
    return out.select("field_name", "cluster_id", *[r6(c).alias(c) for c in out.columns[2:]])


@reg(
    "persist_coordinates", "V5 A9",
    """SELECT coalesce(a.field_name, b.field_name) AS field_name, coalesce(a.cluster_id, b.cluster_id) AS cluster_id,
      coalesce(a.run_id, b.run_id) AS run_id, round(coalesce(b.y, a.x), 6) AS x
    FROM (SELECT * FROM newest WHERE projection_method = 'pca') a FULL JOIN (SELECT * FROM newest WHERE run_id <> 'run_0' AND projection_method = 'pca') b
      ON a.field_name = b.field_name AND a.cluster_id = b.cluster_id AND a.run_id = b.run_id""",
    "fx_coordinates",
    newest="""SELECT * FROM fx_coordinates QUALIFY row_number() OVER (PARTITION BY field_name, cluster_id, projection_method, run_id
      ORDER BY created_at DESC) = 1""",
)
def _(t):
    from ..sources.io import latest_per_key

    keys = ["field_name", "cluster_id", "projection_method", "run_id"]
    newest = latest_per_key(t.coordinates(), keys, [F.col("created_at").desc()]).filter("projection_method = 'pca'")
    moved = newest.filter("run_id <> 'run_0'").withColumn("x", F.col("y"))
    return L.persist_coordinates(newest, moved).select("field_name", "cluster_id", "run_id", r6("x").alias("x"))


@reg(
    "layout_extent", "V6",
    """SELECT round(max(x) FILTER (rx = clip), 6) AS x_low, round(max(x) FILTER (rx = n - 1 - clip), 6) AS x_high,
      round(max(y) FILTER (ry = clip), 6) AS y_low, round(max(y) FILTER (ry = n - 1 - clip), 6) AS y_high
    FROM (SELECT embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, row_number() OVER (ORDER BY embedding[1], vec_id) - 1 AS rx,
      row_number() OVER (ORDER BY embedding[2], vec_id) - 1 AS ry, count(*) OVER () AS n, floor(count(*) OVER () * 0.02) AS clip FROM embeddings)""",
)
def _(t):
    e = t.given("embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    out = L.layout_extent(e)
    return out.select(*[r6(c).alias(c) for c in out.columns])


@reg(
    "layout_neighbors", "V7",
    """SELECT a.vec_id AS id, cast(b.vec_id AS VARCHAR) AS neighbor, cast(row_number() OVER (PARTITION BY a.vec_id ORDER BY d, cast(b.vec_id AS VARCHAR)) AS INT) AS rank
    FROM (SELECT x.vec_id AS i, y.vec_id AS j, round(x.x * x.x + x.y * x.y + (y.x * y.x + y.y * y.y) - 2 * (x.x * y.x + x.y * y.y), 9) AS d
      FROM pt x JOIN pt y ON x.vec_id <> y.vec_id) n JOIN pt a ON a.vec_id = i JOIN pt b ON b.vec_id = j
    QUALIFY rank <= 6""",
    pt="SELECT vec_id, embedding[1]::DOUBLE * 100 AS x, embedding[2]::DOUBLE * 100 AS y FROM embeddings",
)
def _(t):
    e = t.given("embeddings").select(
        F.col("vec_id").alias("id"), (F.col("embedding")[0].cast("double") * 100).alias("x"),
        (F.col("embedding")[1].cast("double") * 100).alias("y"))
    out = L.layout_neighbors(e)
    return out.select(F.col("q_id").cast("bigint").alias("id"), F.col("t_id").alias("neighbor"), "rank")


