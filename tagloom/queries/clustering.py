"""Queries over neighbours, graphs and density clusters."""

from pyspark.sql import functions as F

from ..lineage import cut
from ..operators import centroids as C
from ..operators import density as D
from ..operators import graph as G
from ..operators.blocks import knn
from ..operators.near_knn import approximate_knn
from ..oracles import expr as X
from ..oracles.fixtures import unit
from .reports import reg
from .text_jobs import facts
from .vectors import r6, total


def neighbors(t, k, min_sim=-1.0):
    return knn(t.label_vectors(), ["field_name"], "raw_label", "v", k, min_sim)


KNN = """SELECT a.field_name, a.raw_label AS q_id, b.raw_label AS t_id, round(list_inner_product(a.v, b.v), 9) AS sim,
    row_number() OVER (PARTITION BY a.field_name, a.raw_label ORDER BY round(list_inner_product(a.v, b.v), 9) DESC, b.raw_label) AS rank
  FROM fx_label_vectors a JOIN fx_label_vectors b ON a.field_name = b.field_name AND a.raw_label <> b.raw_label"""


@reg("knn", "E7", "SELECT field_name, q_id, t_id, round(sim, 6) AS sim, cast(rank AS INT) AS rank FROM nn WHERE rank <= 5",
     "fx_label_vectors", nn=KNN)
def _(t):
    return neighbors(t, 5).withColumn("sim", r6("sim"))


EDGES = """SELECT field_name, src, dst, max(sim) AS weight FROM (SELECT field_name, least(q_id, t_id) AS src, greatest(q_id, t_id) AS dst, sim
  FROM nn WHERE rank <= 8 AND sim >= 0.72) GROUP BY ALL HAVING count(*) = 2"""


def edges(t):
    # Neighbours come best first, so those below the threshold rank behind all others and need not be found.
    return G.mutual_knn_edges(neighbors(t, 8, 0.72), 8, 0.72)


@reg("mutual_knn_edges", "E8", "SELECT field_name, src, dst, round(weight, 6) AS weight FROM edges",
     "fx_label_vectors", nn=KNN, edges=EDGES)
def _(t):
    return edges(t).withColumn("weight", r6("weight"))


# Components by label propagation in a recursive CTE (RECURSIVE is set by the caller below).
REACH = """SELECT src AS node, src AS reach FROM ends UNION
  SELECT r.node, e.dst FROM reach r JOIN ends e ON e.src = r.reach"""
COMPONENT_STEPS = {
    "nn": KNN, "edges": EDGES,
    "ends": "SELECT src, dst FROM edges UNION SELECT dst, src FROM edges",
    "reach": REACH,
    "comps": "SELECT node, min(reach) AS component FROM reach GROUP BY node",
}


def recursive(decorator_sql: str) -> str:
    return decorator_sql.replace("WITH ", "WITH RECURSIVE ", 1)


def reg_recursive(name, covers, sql, *tables, **steps):
    from ..oracles.fixtures import with_tables
    from ..registry import query

    return query(name, covers, recursive(with_tables(sql, *tables, **steps)))


@reg_recursive("connected_components", "F5", "SELECT node, component FROM comps", "fx_label_vectors", **COMPONENT_STEPS)
def _(t):
    return G.connected_components(edges(t))


def component_communities(t, e):
    """Components of three labels or more as communities: an upper bound of the real ones."""
    comp = G.connected_components(e)
    sizes = comp.groupBy("component").count().filter("count >= 3")
    ids = sizes.withColumn("community", F.substring_index("component", "_", -1).cast("int"))
    fields = t.label_vectors().select(F.col("raw_label").alias("node"), "field_name")
    return comp.join(ids, "component").join(fields, "node").select("field_name", "node", "community")


@reg_recursive(
    "graph_metrics", "F6",
    """SELECT l.field_name, l.total_labels, l.total_occurrences, l.grouped_labels, l.grouped_occurrences, l.graph_communities_found,
      g.largest AS largest_community_size, e.edges, round(l.grouped_labels / l.total_labels
        - (l.total_labels - l.grouped_labels) / l.total_labels * 0.4 - g.largest / l.total_labels * 1.5, 6) AS score,
      round(i.inside / e.two_m - 1.15 * s.sq / (e.two_m * e.two_m), 6) AS modularity
    FROM (SELECT field_name, count(*) AS total_labels, cast(sum(value_count) AS BIGINT) AS total_occurrences, count(component) AS grouped_labels,
        cast(coalesce(sum(value_count) FILTER (component IS NOT NULL), 0) AS BIGINT) AS grouped_occurrences,
        count(DISTINCT component) AS graph_communities_found
      FROM fx_label_vectors LEFT JOIN big ON big.node = raw_label GROUP BY field_name) l
    JOIN (SELECT field_name, max(n) AS largest FROM (SELECT field_name, component, count(*) AS n FROM fx_label_vectors JOIN big ON node = raw_label GROUP BY ALL)
      GROUP BY field_name) g USING (field_name)
    JOIN (SELECT field_name, count(*) AS edges, 2 * sum(weight) AS two_m FROM edges GROUP BY field_name) e USING (field_name)
    JOIN (SELECT field_name, 2 * sum(weight) AS inside FROM edges JOIN big ON node = src GROUP BY field_name) i USING (field_name)
    JOIN (SELECT field_name, sum(d * d) AS sq FROM (SELECT field_name, component, 2 * sum(weight) AS d FROM edges JOIN big ON node = src
      GROUP BY ALL) GROUP BY field_name) s USING (field_name)""",
    "fx_label_vectors", **COMPONENT_STEPS,
    big="SELECT * FROM comps WHERE component IN (SELECT component FROM comps GROUP BY component HAVING count(*) >= 3)",
)
def _(t):
    e = edges(t)
    labels = t.label_vectors().select("field_name", F.col("raw_label").alias("node"), "value_count")
    out = G.graph_metrics(labels, e, component_communities(t, e), ["field_name"])
    return out.select(
        "field_name", "total_labels", "total_occurrences", "grouped_labels", "grouped_occurrences",
        "graph_communities_found", "largest_community_size", "edges", r6("score").alias("score"),
        r6("modularity").alias("modularity"),
    )


def noise_labels(t):
    return t.label_vectors().select("field_name", F.col("raw_label").alias("node"), "value_count", F.col("v").alias("embedding"))


@reg("approximate_knn", "E7", "SELECT field_name, count(*) AS n_labels, true AS recalled FROM fx_label_vectors GROUP BY field_name", "fx_label_vectors")
def _(t):
    """Approximate neighbours beside the exact ones: at least nine of ten are the same, in every field."""
    rows = cut(t.label_vectors().select("field_name", "raw_label", "v"))
    near = approximate_knn(rows, ["field_name"], "raw_label", "v", 5, bucket_rows=64)
    want = knn(rows, ["field_name"], "raw_label", "v", 5).select("field_name", "q_id", "t_id")
    both = want.join(near.select("field_name", "q_id", "t_id", F.lit(1).alias("hit")), ["field_name", "q_id", "t_id"], "left")
    share = both.groupBy("field_name").agg((F.count("hit") >= 0.9 * F.count("*")).alias("recalled"))
    return rows.groupBy("field_name").agg(F.count("*").alias("n_labels")).join(share, "field_name")


@reg("communities", "F4", "", "fx_label_vectors")
def _(t):
    e = edges(t)
    return G.communities(e, graph="field_name")


@reg("graph_sweep", "F7", "", "fx_label_vectors")
def _(t):
    values, _, _ = G.graph_sweep(noise_labels(t), [3, 5], [0.90, 0.92, 0.94])
    return values.drop("embedding")


# Mappings ----------------------------------------------------------------------------------

MAPPING = """SELECT l.field_name, l.raw_label AS label_id, l.raw_label, l.value_count, l.v, l.vec_id, b.base AS base_cluster_id,
    CASE WHEN b.strict <> -1 THEN 'strict_graph_recovery' WHEN b.base <> -1 THEN 'base_hdbscan' ELSE 'true_anomaly' END AS final_cluster_source,
    CASE WHEN b.strict <> -1 THEN 'strict_' || b.strict WHEN b.base <> -1 THEN 'base_' || b.base ELSE 'anomaly' END AS final_cluster_id,
    b.strict = -1 AND b.base = -1 AS final_is_true_anomaly
  FROM fx_label_vectors l JOIN (SELECT vec_id, CASE WHEN w >= 0.8 THEN idx ELSE -1 END AS base,
    CASE WHEN w BETWEEN 0.5 AND 0.6 THEN idx % 4 ELSE -1 END AS strict FROM fx_label_vectors) b USING (vec_id)"""


def mapping(t):
    lv = t.label_vectors().select("field_name", F.col("raw_label").alias("label_id"), "raw_label", "value_count", "v", "vec_id", "w", "idx")
    base = lv.withColumn("base_cluster_id", F.when(F.col("w") >= 0.8, F.col("idx")).otherwise(-1))
    strict = lv.filter("w < 0.8").select(
        "field_name", "label_id", F.when(F.col("w") > 0.5, F.col("idx") % 4).otherwise(-1).alias("strict_graph_community_id")
    )
    return G.combined_mapping(base, strict)


@reg("combined_mapping", "F8",
     "SELECT label_id, base_cluster_id, final_cluster_source, final_cluster_id, final_is_true_anomaly FROM m",
     "fx_label_vectors", m=MAPPING)
def _(t):
    return mapping(t).select("label_id", F.col("base_cluster_id").cast("bigint").alias("base_cluster_id"),
                             "final_cluster_source", "final_cluster_id", "final_is_true_anomaly")


@reg(
    "cluster_registry", "F9",
    f"""SELECT s.*, round(list_sum({unit('mean')}), 6) AS total FROM (
      SELECT field_name, final_cluster_id, count(DISTINCT raw_label) AS label_count, cast(sum(value_count) AS BIGINT) AS total_occurrences,
        string_agg(DISTINCT final_cluster_source, ' | ' ORDER BY final_cluster_source) AS final_cluster_source,
        first(raw_label ORDER BY value_count DESC, raw_label) AS medoid_label FROM m WHERE NOT final_is_true_anomaly GROUP BY ALL) s
    JOIN (SELECT field_name, final_cluster_id, list(a ORDER BY pos) AS mean FROM (SELECT field_name, final_cluster_id, pos, avg(x) AS a
      FROM (SELECT field_name, final_cluster_id, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM m) GROUP BY ALL) GROUP BY ALL) c
      USING (field_name, final_cluster_id)""".replace("SELECT s.*, round", "SELECT s.*, round"),
    "fx_label_vectors", m=MAPPING,
)
def _(t):
    return C.registry(mapping(t)).select(
        "field_name", "final_cluster_id", "label_count", "total_occurrences", "final_cluster_source", "medoid_label",
        r6(total(F.col("centroid_embedding"))).alias("total"),
    )


@reg(
    "graph_stats", "E15",
    """SELECT label_id, round(CASE WHEN final_cluster_source = 'strict_graph_recovery' THEN w END, 6) AS graph_max_cosine_sim,
      final_cluster_source = 'strict_graph_recovery' AND w IS NOT NULL AS graph_mutual_knn
    FROM m LEFT JOIN (SELECT label_id, max(weight) AS w FROM (SELECT src AS label_id, weight FROM edges UNION ALL SELECT dst, weight FROM edges)
      GROUP BY label_id) USING (label_id)""",
    "fx_label_vectors", m=MAPPING, nn=KNN, edges=EDGES,
)
def _(t):
    out = G.graph_stats(mapping(t), edges(t).withColumn("mutual_knn", F.lit(True)))
    return out.select("label_id", r6("graph_max_cosine_sim").alias("graph_max_cosine_sim"), "graph_mutual_knn")


@reg(
    "summarize_clusters", "F10",
    """SELECT base_cluster_id, base_cluster_id = -1 AS is_noise, count(*) AS label_count, cast(sum(value_count) AS BIGINT) AS total_occurrences,
      string_agg(DISTINCT field_name, ' | ' ORDER BY field_name) AS source_columns,
      array_to_string(list(raw_label ORDER BY label_id)[1:25], ' | ') AS sample_labels FROM m GROUP BY base_cluster_id""",
    "fx_label_vectors", m=MAPPING,
)
def _(t):
    return G.summarize_clusters(
        mapping(t).withColumn("base_cluster_id", F.col("base_cluster_id").cast("bigint")), "base_cluster_id"
    )


@reg(
    "family_tests", "F11",
    f"""SELECT family_token, count(*) AS label_count, cast(sum(value_count) AS BIGINT) AS total_occurrences,
      count(DISTINCT community) AS community_count, count(*) FILTER (community <> -1) AS grouped_count,
      count(*) FILTER (community = -1) AS isolated_count, round(count(*) FILTER (community = -1) / count(*), 6) AS isolated_ratio,
      array_to_string(list_sort(list_distinct(list(community)))[1:20], ', ') AS communities_seen,
      array_to_string(list(raw_label ORDER BY label_id)[1:25], ' | ') AS sample_labels
    FROM (SELECT *, string_split({X.norm_cluster('raw_label')}, ' ')[1] AS family_token, field_name || '/' || raw_label AS label_id,
      CASE WHEN length(raw_label) % 5 = 0 THEN -1 ELSE length(raw_label) % 5 END AS community FROM label_facts)
    GROUP BY family_token HAVING count(*) >= 3""",
    "fx_calls", **X.label_facts(),
)
def _(t):
    n = F.length("raw_label") % 5
    df = facts(t).withColumns({
        "label_id": F.concat_ws("/", "field_name", "raw_label"),
        "community": F.when(n == 0, -1).otherwise(n).cast("bigint"),
    })
    return G.family_tests(df).withColumn("isolated_ratio", r6("isolated_ratio"))


@reg(
    "weighted_sample", "F12",
    """SELECT doc_id, n_chars FROM documents ORDER BY -ln((cast('0x' || left(md5(doc_id || '|42'), 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
      / greatest(1.0::DOUBLE, n_chars::DOUBLE), doc_id LIMIT 150""",
)
def _(t):
    return G.weighted_sample(t.given("documents").select("doc_id", "n_chars"), 150, "doc_id", "n_chars")


# Density -----------------------------------------------------------------------------------


@reg(
    "silhouette", "F3",
    """SELECT field_name, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 5) AS silhouette, count(*) AS points FROM (
      SELECT field_name, q, max(CASE WHEN same AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN NOT same THEN s / n END) AS b FROM (
        SELECT x.field_name, x.raw_label AS q, y.idx, x.idx = y.idx AS same, count(*) AS n,
          sum(sqrt(greatest(round(2 - 2 * list_inner_product(x.v, y.v), 9), 0))) AS s
        FROM fx_label_vectors x JOIN fx_label_vectors y ON x.field_name = y.field_name GROUP BY ALL) GROUP BY field_name, q) GROUP BY field_name""",
    "fx_label_vectors",
)
def _(t):
    out = D.silhouette(t.label_vectors(), ["field_name"], "raw_label", "v", "idx")
    return out.withColumn("silhouette", F.round("silhouette", 5))


@reg("density_cluster", "F1", "", "fx_label_vectors")
def _(t):
    return D.density_cluster(t.label_vectors(), row_id="raw_label")


@reg("tune_density", "F2", "", "fx_label_vectors")
def _(t):
    labels, scores = D.tune_density(t.label_vectors(), [5, 8, 12, 20, 30], [1, 2, 3, 5], row_id="raw_label")
    return scores
