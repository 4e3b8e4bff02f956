"""Queries over vectors, embeddings and centroids."""

import uuid

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..lineage import checkpoint_dir, cut
from ..operators import centroids as C
from ..operators.centroid_sums import CentroidSums
from ..operators import embedding as E
from ..oracles import expr as X
from ..oracles.fixtures import unit, with_tables
from ..registry import query
from .text_jobs import facts


def r6(c):
    return F.round(c, 6)


def total(v):
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


@query(
    "vector_functions", "D1 D2",
    with_tables(
        f"""SELECT l.vec_id, round(list_cosine_similarity(l.v, c.centroid_embedding), 6) AS cos_centroid,
          round(list_inner_product(e.e, l.v), 6) AS dot_raw,
          round(list_sum({unit('e.e')}), 6) AS unit_sum
        FROM fx_label_vectors l JOIN fx_raw_vectors e USING (vec_id)
        JOIN fx_clusters c USING (field_name, cluster_id)""",
        "fx_label_vectors", "fx_clusters",
    ),
)
def _(t):
    lv = t.label_vectors()
    e = t.given("embeddings").select("vec_id", V.as_double(F.col("embedding")).alias("e"))
    c = t.clusters().select("field_name", "cluster_id", "centroid_embedding")
    return lv.join(e, "vec_id").join(c, ["field_name", "cluster_id"]).select(
        "vec_id",
        r6(V.cosine(F.col("v"), F.col("centroid_embedding"))).alias("cos_centroid"),
        r6(V.dot(F.col("e"), F.col("v"))).alias("dot_raw"),
        r6(total(V.l2_normalize(F.col("e")))).alias("unit_sum"),
    )


@query(
    "embed_labels", "D3 D4",
    with_tables(
        f"""SELECT field_name, raw_label, 64::BIGINT AS dim, round(v[1], 6) AS v1, round(v[64], 6) AS v64 FROM (
          SELECT field_name, raw_label, {unit('raw')} AS v FROM (
            SELECT field_name, raw_label, list_transform(range(64),
              lambda i: cast('0x' || substr(h, cast(2 * i + 1 AS BIGINT), 2) AS INT) / 255.0::DOUBLE - 0.5) AS raw
            FROM (SELECT field_name, raw_label, d1 || sha256(unhex(d1)) AS h FROM (
              SELECT field_name, raw_label, sha256(unhex(sha256(
                {X.embedding_text('field_name', 'raw_label', X.norm_mapper('raw_label'))}))) AS d1 FROM label_facts))))""",
        "fx_calls", **X.label_facts(),
    ),
)
def _(t):
    from ..functions.embedtext import embedding_text

    texts = facts(t).withColumn("text", embedding_text(F.col("field_name"), F.col("raw_label")))
    return E.embed(texts, "text", None, 64).select(
        "field_name", "raw_label", F.size("embedding").cast("bigint").alias("dim"),
        r6(F.get("embedding", F.lit(0))).alias("v1"), r6(F.get("embedding", F.lit(63))).alias("v64"),
    )


@query(
    "cached_embeddings", "D5",
    with_tables(
        """SELECT field_name, raw_label, vec_id % 4 <> 0 AS from_cache,
          CASE WHEN vec_id % 4 <> 0 THEN round(v[1], 6) END AS cached_v1 FROM fx_label_vectors""",
        "fx_label_vectors",
    ),
)
def _(t):
    labels = t.label_vectors().select("field_name", "raw_label")
    cache = t.label_embeddings().filter("cast(split(raw_label, '_')[1] as bigint) % 4 <> 0")
    out = E.cached_embeddings(labels, cache, "fields_hash-384_field_label", None, 64)
    return out.select(
        "field_name", "raw_label", "from_cache",
        F.when(F.col("from_cache"), r6(F.get("embedding", F.lit(0)))).alias("cached_v1"),
    )


@query(
    "remove_field_bias", "D6",
    with_tables(
        f"""SELECT vec_id, round(u[1], 6) AS v1, round(u[64], 6) AS v64, round(list_sum(u), 6) AS total FROM (
          SELECT vec_id, {unit('w')} AS u FROM (
            SELECT l.vec_id, list_transform(range(1, len(v) + 1), lambda i: v[i] - list_inner_product(v, d) * d[i]) AS w
            FROM fx_label_vectors l JOIN dirs USING (field_name)))""",
        "fx_label_vectors",
        means="""SELECT field_name, list(m ORDER BY pos) AS m FROM (
          SELECT field_name, pos, avg(x) AS m FROM (SELECT field_name, unnest(v) AS x,
            generate_subscripts(v, 1) AS pos FROM fx_label_vectors) GROUP BY field_name, pos) GROUP BY field_name""",
        dirs=f"SELECT field_name, {unit('m')} AS d FROM means",
    ),
)
def _(t):
    out = E.remove_field_bias(t.label_vectors().select("vec_id", "field_name", "v"))
    v = F.col("v")
    return out.select(
        "vec_id", r6(F.get(v, F.lit(0))).alias("v1"), r6(F.get(v, F.lit(63))).alias("v64"),
        r6(total(v)).alias("total"),
    )


@query(
    "cluster_vector_from_labels", "D7",
    with_tables(
        f"""SELECT c.id, coalesce(round(list_sum({unit('m')}), 6), 0.0) AS total, coalesce(n, 0) AS label_rows
        FROM fx_clusters c LEFT JOIN lm USING (field_name, cluster_id)""",
        "fx_clusters", "fx_label_vectors",
        lm="""SELECT field_name, cluster_id, list(m ORDER BY pos) AS m, any_value(n) AS n FROM (
          SELECT field_name, cluster_id, pos, sum(x * value_count) / sum(value_count) AS m, count(*) AS n
          FROM (SELECT field_name, cluster_id, value_count, unnest(v) AS x, generate_subscripts(v, 1) AS pos
            FROM fx_label_vectors WHERE label <> 4) GROUP BY ALL) GROUP BY ALL""".replace(
            "WHERE label <> 4", "WHERE cluster_id <> 'base_4'"
        ),
    ),
)
def _(t):
    labels = t.label_vectors().filter("cluster_id <> 'base_4'")
    out = E.cluster_vector_from_labels(t.clusters(), labels)
    return out.select("id", r6(total(F.col("label_vector"))).alias("total"), "label_rows")


# Members, centroids -----------------------------------------------------------------------

MEMBERS_RAW = """
  SELECT c.field_name, c.run_id, c.cluster_version, c.cluster_id, m.raw_label, m.normalized_label,
    m.value_count, l.v AS embedding
  FROM fx_clusters c JOIN fx_label_map m ON m.field_name = c.field_name AND m.run_id = c.run_id
    AND m.cluster_version = c.cluster_version AND m.final_cluster_id = c.cluster_id
  JOIN fx_label_vectors l ON l.field_name = m.field_name AND l.raw_label = m.raw_label
  WHERE NOT m.final_is_true_anomaly"""
MEMBERS_NORM = """
  SELECT c.field_name, c.run_id, coalesce(c.cluster_version, 'v1') AS cluster_version, c.cluster_id, m.raw_label,
    m.normalized_label, m.value_count, l.v AS embedding
  FROM fx_clusters c JOIN fx_label_map m ON m.field_name = c.field_name
    AND coalesce(m.cluster_version, 'v1') = coalesce(c.cluster_version, 'v1') AND m.final_cluster_id = c.cluster_id
  JOIN fx_label_vectors l ON l.field_name = m.field_name AND l.normalized_label = m.normalized_label"""
_K = "field_name, run_id, cluster_version, cluster_id"

for _by, _members in (("raw", MEMBERS_RAW), ("normalized", MEMBERS_NORM)):

    def _build(t, by=_by):
        m = C.centroid_members(t.clusters(), t.label_map(), t.label_embeddings(), by)
        return m.groupBy(*C.KEY).agg(
            F.count("*").alias("n_rows"), F.sum("value_count").alias("weight"),
            F.count("embedding").alias("n_vectors"), F.min("raw_label").alias("first_label"),
        )

    query(
        f"centroid_members_{_by}", "E14",
        with_tables(
            f"""SELECT {_K}, count(*) AS n_rows, cast(sum(value_count) AS BIGINT) AS weight,
              count(embedding) AS n_vectors, min(raw_label) AS first_label FROM members GROUP BY ALL""",
            "fx_clusters", "fx_label_map", members=_members,
        ),
    )(_build)


def centroid_steps(members: str, weighted: bool, rep_sim: bool, limit: int) -> dict[str, str]:
    w = "value_count" if weighted else "1"
    order = "value_count DESC, sim DESC, raw_label" if rep_sim else "value_count DESC, raw_label"
    return {
        "members": members,
        "mean_parts": f"""SELECT {_K}, pos, sum(x * {w}) / sum({w}) AS m FROM (
          SELECT {_K}, value_count, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM members)
          GROUP BY ALL""",
        "cents": f"SELECT {_K}, {unit('m')} AS c FROM (SELECT {_K}, list(m ORDER BY pos) AS m FROM mean_parts GROUP BY ALL)",
        "scored": f"""SELECT m.*, c.c, round(list_cosine_similarity(m.embedding, c.c), 9) AS sim
          FROM members m JOIN cents c ON c.field_name = m.field_name AND c.cluster_id = m.cluster_id
            AND c.run_id = m.run_id AND c.cluster_version IS NOT DISTINCT FROM m.cluster_version""",
        "centroid_rows": f"""SELECT {_K}, round(any_value(list_sum(c)), 6) AS total,
          first(raw_label ORDER BY sim DESC, raw_label) AS medoid_label, round(max(sim), 6) AS medoid_similarity,
          count(DISTINCT raw_label) AS cluster_size, cast(sum(value_count) AS BIGINT) AS total_occurrences,
          array_to_string(list(raw_label ORDER BY {order})[1:{limit}], ',') AS reps FROM scored GROUP BY {_K}""",
    }


def centroid_columns(df):
    return df.select(
        *C.KEY, r6(total(F.col("centroid"))).alias("total"), "medoid_label",
        r6("medoid_similarity").alias("medoid_similarity"), "cluster_size", "total_occurrences",
        F.array_join("representatives.raw_label", ",").alias("reps"),
    )


for _mode, _by, _w, _s, _n in (
    ("rebuild", "raw", True, True, 12), ("backfill", "normalized", True, False, 12),
    ("weekly", "normalized", False, False, 10),
):

    def _build(t, mode=_mode, by=_by):
        m = C.centroid_members(t.clusters(), t.label_map(), t.label_embeddings(), by)
        return centroid_columns(C.centroids(m, mode))

    query(
        f"centroids_{_mode}", "G1" + (" G23" if _mode == "weekly" else ""),
        with_tables(
            "SELECT * FROM centroid_rows", "fx_clusters", "fx_label_map",
            **centroid_steps(MEMBERS_RAW if _by == "raw" else MEMBERS_NORM, _w, _s, _n),
        ),
    )(_build)

@query(
    "centroids_by_differences", "G1 G23 G28",
    with_tables(
        "SELECT field_name, run_id, cluster_version, cluster_id, total, medoid_label FROM centroid_rows", "fx_clusters", "fx_label_map",
        **centroid_steps(MEMBERS_NORM, False, False, 10),
    ),
)
def _(t):
    """Centroids after two changes: half of the members, with some that do not belong; then the others come and those go."""
    members = cut(C.centroid_members(t.clusters(), t.label_map(), t.label_embeddings(), "normalized"))
    first = F.pmod(F.xxhash64("raw_label"), F.lit(2)) == 0
    strangers = members.filter(~first).withColumn("embedding", F.reverse("embedding"))
    sums = CentroidSums(t.spark, f"{checkpoint_dir(t.spark)}/sums-{uuid.uuid4().hex}", weighted=False, buckets=8)
    sums.change(members.filter(first).unionByName(strangers))
    sums.change(members.filter(~first), strangers)
    sums.choose(members)
    out = sums.centroids().join(sums.medoids.read(), C.KEY)
    return out.select(*C.KEY, r6(total(F.col("centroid"))).alias("total"), "medoid_label")


_STANDARD = "coalesce(active, true) AND NOT coalesce(is_true_anomaly_cluster, false)"


@query(
    "rebuild_review", "G2",
    with_tables(
        f"""SELECT c.id, r.medoid_label, r.medoid_similarity, r.total, r.reps, r.cluster_size AS size_after,
          c.cluster_size AS size_before
        FROM fx_clusters c JOIN centroid_rows r USING (field_name, run_id, cluster_version, cluster_id)
        WHERE {_STANDARD}""",
        "fx_clusters", "fx_label_map", **centroid_steps(MEMBERS_RAW, True, True, 12),
    ),
)
def _(t):
    clusters = t.clusters()
    review, _ = C.rebuild_centroids(clusters, t.label_map(), t.label_embeddings())
    ids = clusters.select("id", *C.KEY)
    return review.join(ids, C.KEY).select(
        "id", "medoid_label", r6("medoid_similarity").alias("medoid_similarity"),
        r6(total(F.col("centroid"))).alias("total"),
        F.array_join("representatives.raw_label", ",").alias("reps"),
        F.col("cluster_size").alias("size_after"), F.col("size_before"),
    )


@query(
    "rebuild_issues", "G2",
    with_tables(
        f"""SELECT field_name, cluster_id, 'no_usable_embeddings' AS issue, 0::BIGINT AS label_rows
        FROM fx_clusters WHERE cluster_version IS NULL AND {_STANDARD}""",
        "fx_clusters",
    ),
)
def _(t):
    _, issues = C.rebuild_centroids(t.clusters(), t.label_map(), t.label_embeddings())
    return issues.select("field_name", "cluster_id", "issue", F.col("label_rows").cast("bigint").alias("label_rows"))
