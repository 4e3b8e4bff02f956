"""Operators over structures planted in the given tables, whose right result SQL can state."""

from pyspark.sql import functions as F

from ..functions.keys import row_hashes
from ..functions.text import normalize_label
from ..lineage import cut
from ..operators import backfill as B
from ..operators import density as D
from ..operators import graph as G
from ..operators import layout as L
from ..operators import weekly as W
from ..operators.blocks import knn, nearest_points
from ..operators.labels import explode_calls
from ..oracles import expr as X
from ..plans import clustering, maintenance
from ..plans.runs import run_recorded
from ..plans.mapping import run_mapping
from ..registry import query
from ..sources import io, schemas
from ..sources.keyed import KeyedTable
from ..streaming import mapper
from .clustering import KNN
from .reports import reg
from .runs import CONFIG, MAPPED, call_taxonomy, target
from .tables import END, START
from .text_jobs import CALL_FIELDS
from .vectors import r6
from .weekly import field_config

# Six customers in a row are a clique, fifty cliques a graph; the last of a clique has a weak edge to the next one.
CLIQUE, GRAPH = 6, 300
CLIQUES = f"""SELECT graph, node, CASE WHEN n >= 3 THEN id ELSE -1 END AS community FROM (
  SELECT *, dense_rank() OVER (PARTITION BY graph ORDER BY n DESC, least_node) - 1 AS id FROM (
    SELECT 'g' || (c_custkey // {GRAPH}) AS graph, c_custkey::VARCHAR AS node, count(*) OVER w AS n,
      min(c_custkey::VARCHAR) OVER w AS least_node
    FROM customer WINDOW w AS (PARTITION BY c_custkey // {CLIQUE})))"""


def planted_edges(t):
    c = t.given("customer").select(F.col("c_custkey").alias("k")).withColumn("clique", F.expr(f"k div {CLIQUE}"))
    graph = F.concat(F.lit("g"), F.expr(f"k div {GRAPH}"))
    a = c.select(graph.alias("graph"), "clique", F.col("k").alias("src"))
    b = c.select("clique", F.col("k").alias("dst"))
    inside = a.join(b, "clique").filter("src < dst").select("graph", "src", "dst", F.lit(1.0).alias("weight"))
    after = c.select((F.col("k") - 1).alias("src"), F.col("k").alias("dst"), graph.alias("graph")).filter(
        f"dst % {CLIQUE} = 0 and dst % {GRAPH} <> 0")
    bridges = after.join(c.select(F.col("k").alias("src")), "src").select("graph", "src", "dst", F.lit(0.05).alias("weight"))
    return inside.unionByName(bridges)


@query("communities_planted", "F4", CLIQUES)
def _(t):
    return G.communities(planted_edges(t), graph="graph")


# Parts of a group point one way: every group of five parts or more is a cluster, the others are noise.
GROUPS = """SELECT field_name, label_id, CASE WHEN n >= 5 THEN dense_rank() OVER (PARTITION BY field_name ORDER BY n DESC, least_id) - 1 ELSE -1 END AS base_cluster_id
  FROM (SELECT field_name, label_id, count(*) OVER w AS n, min(label_id) OVER w AS least_id FROM (
    SELECT 'f' || (p_partkey % 3) AS field_name, p_partkey::VARCHAR AS label_id, p_partkey % 7 AS grp FROM part)
    WINDOW w AS (PARTITION BY field_name, grp))"""


def planted_points(t):
    k = F.col("p_partkey")
    axes = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.when(i == k % 7, 1.0).otherwise(0.0))
    return t.given("part").select(
        F.concat(F.lit("f"), (k % 3).cast("string")).alias("field_name"), k.cast("string").alias("label_id"), axes.alias("v"))


@query("density_planted", "F1", GROUPS)
def _(t):
    found = D.density_cluster(planted_points(t), 5, 2)
    return found.select("field_name", "label_id", F.col("base_cluster_id").cast("bigint").alias("base_cluster_id"))


@query("tune_density_planted", "F2", GROUPS)
def _(t):
    """Whatever the grid, the planted groups come back."""
    found, _ = D.tune_density(planted_points(t), [5, 8], [1, 2])
    return found.select("field_name", "label_id", F.col("base_cluster_id").cast("bigint").alias("base_cluster_id"))


@query("condense_levels_planted", "F1", GROUPS)
def _(t):
    """The same groups from trees that are merged in many levels and slices."""
    points = planted_points(t)
    edges = D.spanning_forest(points, 2).withColumn("mcs", F.lit(5))
    found = D.condense(points.select("field_name", F.col("label_id").alias("rid")), edges, ["field_name"], slice_edges=200)
    return found.select("field_name", F.col("rid").alias("label_id"), F.col("cluster_id").cast("bigint").alias("base_cluster_id"))


def planted_noise(t):
    """Parts by four: the three last of each four point one way of their own, the first points nowhere near them."""
    k = F.col("p_partkey")
    return t.given("part").select(
        F.concat(F.lit("f"), F.expr("p_partkey div 400").cast("string")).alias("field_name"), k.cast("string").alias("node"), F.lit(1).alias("value_count"),
        F.transform(F.sequence(F.lit(0), F.lit(199)), lambda i: F.when(
            i == F.expr("(p_partkey div 4) % 100") + F.when(k % 4 == 0, 100).otherwise(0), 1.0).otherwise(0.0)).alias("embedding"))


@query("graph_sweep_planted", "F7 E8 F6", """SELECT field_name, node, CASE WHEN n >= 3 THEN dense_rank() OVER (PARTITION BY field_name ORDER BY n >= 3 DESC, least_node) - 1
      ELSE -1 END AS community, CASE WHEN found > 0 THEN 3 END AS best_k, CASE WHEN found > 0 THEN 0.9 END::DOUBLE AS best_threshold FROM (
    SELECT *, count(*) FILTER (n >= 3) OVER (PARTITION BY field_name) AS found FROM (
    SELECT 'f' || (p_partkey // 400) AS field_name, p_partkey::VARCHAR AS node, count(*) OVER w AS n, min(p_partkey::VARCHAR) OVER w AS least_node
    FROM part WINDOW w AS (PARTITION BY p_partkey // 4, p_partkey % 4 = 0)))""")
def _(t):
    """Threes that belong together among labels that are alone, in every graph of the sweep; ties go to its first."""
    values, _, _ = G.graph_sweep(planted_noise(t), [3, 5], [0.90, 0.94])
    found = values.select("field_name", "node", F.col("community").cast("bigint").alias("community"))
    best = values.groupBy("field_name").agg(F.max("best_k").alias("best_k"), F.max("best_threshold").alias("best_threshold"))
    return found.join(best, "field_name")


@query("cluster_labels_planted", "F13 F9", f"""SELECT field_name, count(*) AS total_labels, count(*) FILTER (base_cluster_id <> -1) AS base_hdbscan_labels,
    count(DISTINCT base_cluster_id) FILTER (base_cluster_id <> -1) AS final_cluster_count FROM ({GROUPS}) GROUP BY field_name""")
def _(t):
    """The whole run over the planted groups."""
    labels = planted_points(t).withColumns({"raw_label": F.col("label_id"), "value_count": F.lit(1)})
    return clustering.cluster_labels(labels).report.select("field_name", "total_labels", "base_hdbscan_labels", "final_cluster_count")


@reg("pca3_moments", "V2", """SELECT count(*) AS n_rows, 0.0::DOUBLE AS mean, 0.0::DOUBLE AS covariance, true AS falling, true AS within_total FROM fx_label_vectors""",
     "fx_label_vectors")
def _(t):
    """What must hold of principal components: no mean, no covariance, variances that fall and sum to at most the total."""
    rows = t.label_vectors().select("vec_id", "v")
    out = L.pca3(rows)
    pairs = [("x", "y"), ("x", "z"), ("y", "z")]
    total = rows.select(F.posexplode("v").alias("i", "c")).groupBy("i").agg(F.var_samp("c").alias("s")).agg(F.sum("s").alias("total"))
    worst = F.round(F.greatest(*[F.abs(F.avg(c)) for c in "xyz"]), 5), F.round(F.greatest(*[F.abs(F.covar_samp(*p)) for p in pairs]), 5)
    var = [F.var_samp(c) for c in "xyz"]
    one = out.agg(F.count("*").alias("n_rows"), worst[0].alias("mean"), worst[1].alias("covariance"),
                  ((var[0] >= var[1]) & (var[1] >= var[2])).alias("falling"), (var[0] + var[1] + var[2]).alias("_sum"))
    return one.join(F.broadcast(total)).select("n_rows", "mean", "covariance", "falling", (F.col("_sum") <= F.col("total") + 1e-9).alias("within_total"))  # one row


@reg("weekly_run_rows", "G13 G14 G17 G18", """SELECT count(*) AS n_rows, count(*) FILTER (mapping_status IN ('EXISTING_CLUSTER', 'NO_CLUSTER_REFERENCE')) AS settled_before,
    0::BIGINT AS lost, 0::BIGINT AS settled_changed FROM fx_outputs""", "fx_outputs")
def _(t):
    """A whole week keeps every output once, and leaves those that were settled as they were."""
    before = cut(t.outputs_with_candidates())
    clusters = t.clusters().withColumn("representative_labels", F.lit(None).cast("array<string>"))
    state = W.State(clusters, t.names(), t.label_map(), before, t.label_embeddings())
    _, _, new = maintenance.weekly_run(state, field_config(t), START, END, apply=True)
    old = before.select("event_id", F.col("mapping_status").alias("was"), F.col("mapped_cluster_id").alias("was_id"))
    now = new.outputs.groupBy("event_id").agg(F.count("*").alias("n"), F.first("mapping_status").alias("is"), F.first("mapped_cluster_id").alias("is_id"))
    settled = F.col("was").isin("EXISTING_CLUSTER", "NO_CLUSTER_REFERENCE")
    return old.join(now, "event_id", "full").agg(
        F.sum("n").alias("n_rows"), F.count_if(settled).alias("settled_before"), F.count_if(F.col("n").isNull() | F.col("was").isNull()).alias("lost"),
        F.count_if(settled & ~(F.col("was").eqNullSafe(F.col("is")) & F.col("was_id").eqNullSafe(F.col("is_id")))).alias("settled_changed"))


@reg("backfill_run_rows", "G24 G25 G26 G28 G29", "SELECT 0::BIGINT AS differing, true AS some FROM fx_stage LIMIT 1", "fx_stage")
def _(t):
    """The rows that a whole backfill rewrites are those that its own decisions change, cell by cell."""
    state = B.TaxonomyState(t.clusters(), t.names(), t.label_map(), t.label_embeddings())
    fields = ["outcome", "outcome_sub", "additional_tags"]
    run = maintenance.backfill_run(t.stage(), fields, state, io.read_history_counts(t.history()), "clean_auto", dim=64)
    want = cut(B.apply_to_rows(t.stage(), run.decisions, fields).drop("better_tags_updated_at"))
    rows = cut(run.rows.drop("better_tags_updated_at"))
    n = run.counts.select("rows_changed")
    both = rows.withColumn("_n", F.lit(1)).unionByName(want.withColumn("_n", F.lit(-1)))
    apart = both.groupBy(*rows.columns).agg(F.abs(F.sum("_n")).alias("_n"))
    differing = apart.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("differing"))
    return differing.join(F.broadcast(n)).join(F.broadcast(rows.agg(F.count("*").alias("written")))).select(  # one row each
        "differing", ((F.col("written") == F.col("rows_changed")) & (F.col("written") > 0)).alias("some"))


@reg("knn_many_blocks", "E7", "SELECT field_name, q_id, t_id, round(sim, 6) AS sim, cast(rank AS INT) AS rank FROM nn WHERE rank <= 5",
     "fx_label_vectors", nn=KNN)
def _(t):
    """The same neighbours from blocks of sixteen rows, so that cells, bounds and salts are at work."""
    found = knn(t.label_vectors(), ["field_name"], "raw_label", "v", 5, block_rows=16)
    return found.withColumn("sim", r6("sim"))


@reg("knn_without_group", "E7", """SELECT q_id, t_id, sim FROM (SELECT a.field_name || '|' || a.raw_label AS q_id, b.field_name || '|' || b.raw_label AS t_id,
    round(round(list_inner_product(a.v, b.v), 9), 6) AS sim, row_number() OVER (PARTITION BY a.field_name, a.raw_label
      ORDER BY round(list_inner_product(a.v, b.v), 9) DESC, b.field_name || '|' || b.raw_label) AS rank
  FROM fx_label_vectors a JOIN fx_label_vectors b ON a.field_name || '|' || a.raw_label <> b.field_name || '|' || b.raw_label) WHERE rank <= 2""",
     "fx_label_vectors")
def _(t):
    rows = t.label_vectors().withColumn("whole", F.concat_ws("|", "field_name", "raw_label"))
    return knn(rows, [], "whole", "v", 2, block_rows=64).select("q_id", "t_id", r6("sim").alias("sim"))


@query("conform_state", "A15", """SELECT 'run_1' AS run_id, c_mktsegment AS field_name, c_name AS raw_label, lower(c_name) AS normalized_label,
    1::BIGINT AS value_count, c_custkey::VARCHAR AS final_cluster_id, NULL::VARCHAR AS final_cluster_source, 'v1' AS cluster_version FROM customer""")
def _(t):
    """A label map that lacks columns gets them, as nulls or defaults; others are cast or left out."""
    c = t.given("customer").select(
        F.lit("run_1").alias("run_id"), F.col("c_mktsegment").alias("field_name"), F.col("c_name").alias("raw_label"),
        F.lower("c_name").alias("normalized_label"), F.col("c_custkey").alias("final_cluster_id"), "c_acctbal")
    schema = ("run_id string, field_name string, raw_label string, normalized_label string, value_count long, "
              "final_cluster_id string, final_cluster_source string, cluster_version string")
    return schemas.conform(c, schema, schemas.STATE_DEFAULTS)


@reg("run_rows", "A13", """SELECT 'run_ok' AS run_id, 'SUCCESS' AS status, count(*) AS rows_seen, NULL::VARCHAR AS error FROM fx_outputs
    UNION ALL SELECT 'run_bad', 'FAILED', NULL, 'ValueError: no fields'""", "fx_outputs")
def _(t):
    """Run rows of a run that works and of one that fails."""
    good, _ = run_recorded(t.spark, "run_ok", lambda: t.outputs().count())

    def fails():
        raise ValueError("no fields")

    bad, _ = run_recorded(t.spark, "run_bad", fails)
    columns = ["run_id", "status", F.col("rows").alias("rows_seen"), "error"]
    return good.select(*columns).unionByName(bad.select(*columns))


@reg("explode_calls_repeats", "E1", """SELECT 'call_' || l.id AS source_record_id, field_name, normalized_label,
    strftime(c.created_at, '%Y-%m-%d %H:%M:%S') AS first_at FROM call_labels l JOIN fx_calls c USING (id)""", "fx_calls", **X.call_labels())
def _(t):
    """Records that come again a day later: of the rows of a record the earliest stays."""
    calls = t.calls()
    again = calls.withColumn("created_at", F.col("created_at") + F.expr("interval 1 day"))
    rows = explode_calls(again.unionByName(calls), CALL_FIELDS, "calls", "events", "call_id", "created_at")
    return rows.select("source_record_id", "field_name", "normalized_label",
                       F.date_format("source_created_at", "yyyy-MM-dd HH:mm:ss").alias("first_at"))


@reg("stream_equals_batch", "T1 G4", f"""SELECT count(*) AS n_rows, 0::BIGINT AS differing FROM ({MAPPED})""", "fx_calls", **X.call_labels())
def _(t):
    """Rows of the stream and of the batch, all columns with the key but run and time of writing."""
    from ..sources import fixture_sql as fx
    from .runs import event_stream

    taxonomy = call_taxonomy(t)
    part = t.given("part")
    keys = part.agg(F.count("*").alias("n")).first()["n"]
    calls = t.spark.sql(fx.CALLS.replace("(SELECT count(*) FROM {part})", str(keys)), events=event_stream(t), part=part)
    path = target(t, "mapped")
    mapper.map_stream(calls, taxonomy, path, CONFIG, watermark="40 days").awaitTermination()
    streamed = KeyedTable(t.spark, path).read().drop("mapper_run_id", "created_at")
    batch = run_mapping(t.calls(), taxonomy, "run_1", config=CONFIG).drop("mapper_run_id", "created_at").select(*streamed.columns)
    both = row_hashes(streamed, "dedupe_key").select("*", F.lit(1).alias("s"), F.lit(0).alias("b")).unionByName(
        row_hashes(batch, "dedupe_key").select("*", F.lit(0).alias("s"), F.lit(1).alias("b")))
    each = both.groupBy("h1", "h2").agg(F.sum("s").alias("s"), F.sum("b").alias("b"))
    return each.agg(F.sum("s").alias("n_rows"), F.count_if(F.col("s") != F.col("b")).alias("differing"))


# Parts whose type is an array cell: every second word is decided.
ARRAYS = """SELECT p_partkey AS id, list(w ORDER BY pos) AS old, list(CASE WHEN length(w) % 2 = 0 THEN 'Shown ' || w ELSE w END ORDER BY pos) AS new,
    bool_or(length(w) % 2 = 0) AS decided FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS w,
      generate_subscripts(string_split(p_type, ' '), 1) AS pos FROM part) GROUP BY p_partkey"""


def array_stage(t):
    part = t.given("part")
    stage = part.select(F.col("p_partkey").alias("id"), F.split("p_type", " ").alias("additional_tags"))
    words = part.select(F.explode(F.split("p_type", " ")).alias("raw_label")).distinct().filter(F.length("raw_label") % 2 == 0)
    decisions = words.select(
        F.lit("additional_tags").alias("field_name"), normalize_label(F.col("raw_label"), "loose").alias("normalized_label"),
        F.concat(F.lit("Shown "), "raw_label").alias("display_name"))
    return stage, decisions


@query("array_cells", "G29", f"SELECT id, array_to_string(old, ', ') AS old_value, array_to_string(new, ', ') AS new_value FROM ({ARRAYS}) WHERE decided")
def _(t):
    stage, decisions = array_stage(t)
    return B.cell_updates(stage, decisions, ["additional_tags"]).filter("changed").select("id", "old_value", "new_value")


@query("array_cells_applied", "G29", f"SELECT id, array_to_string(new, '|') AS tags FROM ({ARRAYS}) WHERE decided")
def _(t):
    stage, decisions = array_stage(t)
    out = B.apply_to_rows(stage, decisions, ["additional_tags"])
    return out.select("id", F.array_join("additional_tags", "|").alias("tags"))


@query("upsert_null_keys", "A9", """SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_custkey END AS k, max(c_custkey) AS newest FROM customer
    GROUP BY 1""")
def _(t):
    """Keys that are null are one key: the source's row replaces the target's, none is lost."""
    c = t.given("customer").select(F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey")).alias("k"), F.col("c_custkey").alias("newest"))
    first = io.latest_per_key(c.filter("newest % 3 <> 0"), ["k"], [F.col("newest")])
    return io.upsert(first, c, ["k"], rules={"newest": "greatest"}, newest_first=[F.col("newest").desc()])


@query("nearest_points_blocks", "V7", """SELECT q_id, t_id, squared_distance FROM (SELECT a.p_partkey::VARCHAR AS q_id, b.p_partkey::VARCHAR AS t_id,
    round((a.p_size - b.p_size) * (a.p_size - b.p_size) + (a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice), 4)::DOUBLE AS squared_distance,
    row_number() OVER (PARTITION BY a.p_partkey ORDER BY round((a.p_size - b.p_size) * (a.p_size - b.p_size)
      + (a.p_retailprice - b.p_retailprice) * (a.p_retailprice - b.p_retailprice), 9), b.p_partkey::VARCHAR) AS rank
  FROM part a JOIN part b ON a.p_partkey <> b.p_partkey) WHERE rank = 1""")
def _(t):
    p = t.given("part").select("p_partkey", F.array(F.col("p_size").cast("double"), F.col("p_retailprice").cast("double")).alias("v"))
    near = nearest_points(p, "p_partkey", "v", 1)
    return near.select("q_id", "t_id", F.round("squared_distance", 4).alias("squared_distance"))
