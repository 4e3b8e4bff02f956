"""Queries over whole runs: mapper, clustering, weekly, backfill, streams."""

import uuid

from pyspark.sql import functions as F

from ..functions.embedtext import embedding_text
from ..functions.text import normalize_label
from ..lineage import checkpoint_dir, cut
from ..operators import backfill as B
from ..operators import weekly as W
from ..operators.embedding import embed
from ..oracles import expr as X
from ..plans import clustering, maintenance
from ..plans.mapping import MapperConfig, Taxonomy, run_mapping
from ..sources import fixture_sql as fx
from ..sources import io
from ..sources.keyed import KeyedTable
from ..sources.tables import days_after
from ..streaming import anomaly_state, mapper
from .reports import reg
from .tables import END, START
from .text_jobs import CALL_FIELDS, facts
from .weekly import field_config

DIM = 64
CONFIG = MapperConfig(source_table="events", fields=CALL_FIELDS, dim=DIM, unique_ids=True)


def call_taxonomy(t):
    """A taxonomy out of the labels themselves: every label of even length is a cluster.

    Labels of odd length are unknown to the exact map and go through the vectors.
    """
    f = facts(t).withColumn("normalized_label", normalize_label(F.col("raw_label"), "mapper"))
    known = f.filter(F.length("normalized_label") % 2 == 0).withColumns({
        "cluster_id": F.concat(F.lit("c_"), F.col("normalized_label")),
        "text": embedding_text(F.col("field_name"), F.col("raw_label")),
    })
    c = cut(embed(known, "text", None, DIM))
    anomaly = F.length("normalized_label") % 4 == 0
    no = F.lit(None)
    clusters = c.select(
        F.xxhash64("field_name", "cluster_id").alias("id"), F.lit("run").alias("run_id"), "field_name", "cluster_id",
        F.lit("v1").alias("cluster_version"), F.lit("base_hdbscan").alias("cluster_source"),
        F.col("embedding").alias("centroid_embedding"), F.lit(1).alias("cluster_size"),
        F.col("value_count").alias("total_occurrences"), F.col("raw_label").alias("medoid_label"),
        no.cast("double").alias("medoid_similarity_to_centroid"), anomaly.alias("is_true_anomaly_cluster"),
        no.cast("double").alias("similarity_threshold"), F.lit(True).alias("active"),
        no.cast("string").alias("display_name"), no.cast("string").alias("promotion_status"),
        days_after(F.lit(0)).alias("created_at"), days_after(F.lit(0)).alias("updated_at"),
    )
    names = c.select(
        "field_name", "cluster_id", F.lit("run").alias("run_id"), F.lit("v1").alias("cluster_version"),
        F.col("normalized_label").alias("display_name"), F.lit("fixed").alias("naming_method"),
        anomaly.alias("is_anomaly"), F.lit(True).alias("active"),
        days_after(F.lit(0)).alias("created_at"), days_after(F.lit(0)).alias("updated_at"),
    )
    label_map = c.select(
        F.lit("run").alias("run_id"), "field_name", "raw_label", "normalized_label", "value_count",
        F.col("cluster_id").alias("final_cluster_id"), F.lit("base_hdbscan").alias("final_cluster_source"),
        anomaly.alias("final_is_true_anomaly"), F.lit("-1").alias("base_cluster_id"), F.lit("v1").alias("cluster_version"),
    )
    return Taxonomy(clusters, names, label_map)


# Hash vectors of different texts are far apart, so labels without a key stay unresolved.
MAPPED = """SELECT 'call_' || id AS source_record_id, field_name, normalized_label,
  CASE WHEN length(normalized_label) % 4 = 0 THEN 'KNOWN_TRUE_ANOMALY' WHEN length(normalized_label) % 2 = 0 THEN 'EXISTING_CLUSTER'
    ELSE 'TRUE_ANOMALY' END AS mapping_status,
  CASE WHEN length(normalized_label) % 2 = 0 THEN 'c_' || normalized_label END AS mapped_cluster_id,
  CASE WHEN length(normalized_label) % 2 = 0 THEN normalized_label END AS mapped_display_name FROM call_labels"""
_COLUMNS = ["source_record_id", "field_name", "normalized_label", "mapping_status", "mapped_cluster_id", "mapped_display_name"]


@reg("run_mapping", "G4 E1 E2 D3", MAPPED, "fx_calls", **X.call_labels())
def _(t):
    return run_mapping(t.calls(), call_taxonomy(t), "run_1", config=CONFIG).select(*_COLUMNS)


@reg("mapping_status_by_field", "G4 G5",
     "SELECT field_name, mapping_status, count(*) AS n_rows FROM mapped GROUP BY ALL",
     "fx_calls", **X.call_labels(), mapped=MAPPED)
def _(t):
    out = run_mapping(t.calls(), call_taxonomy(t), "run_1", config=CONFIG)
    return out.groupBy("field_name", "mapping_status").agg(F.count("*").alias("n_rows"))


@reg("cluster_labels_run", "F13", "", "fx_label_vectors")
def _(t):
    labels = t.label_vectors().select("field_name", F.col("raw_label").alias("label_id"), "raw_label", "value_count", "v")
    return clustering.cluster_labels(labels).report


@reg("weekly_run", "G13 G14 G15 G21", "", "fx_outputs")
def _(t):
    clusters = t.clusters().withColumn("representative_labels", F.lit(None).cast("array<string>"))
    state = W.State(clusters, t.names(), t.label_map(), t.outputs_with_candidates(), t.label_embeddings())
    _, _, new = maintenance.weekly_run(state, field_config(t), START, END, apply=True)
    return new.outputs.groupBy("field_name", "mapping_status", "mapping_method").agg(F.count("*").alias("n_rows"))


@reg("backfill_run", "G24 G25 G26 G28 G29 E6", "", "fx_stage")
def _(t):
    state = B.TaxonomyState(t.clusters(), t.names(), t.label_map(), t.label_embeddings())
    history = io.read_history_counts(t.history())
    fields = ["outcome", "outcome_sub", "additional_tags"]
    run = maintenance.backfill_run(t.stage(), fields, state, history, "clean_auto", dim=DIM)
    return run.rows.drop("better_tags_updated_at")


# Streams -----------------------------------------------------------------------------------


def event_stream(t):
    """The events file as a stream source."""
    schema = t.spark.read.parquet(f"{t.dir}/events.parquet").schema
    stream = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def target(t, name):
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@reg("map_stream", "T1", MAPPED, "fx_calls", **X.call_labels())
def _(t):
    taxonomy = call_taxonomy(t)
    part = t.given("part")
    keys = part.agg(F.count("*").alias("n")).first()["n"]
    text = fx.CALLS.replace("(SELECT count(*) FROM {part})", str(keys))
    calls = t.spark.sql(text, events=event_stream(t), part=part)
    path = target(t, "mapped")
    mapper.map_stream(calls, taxonomy, path, CONFIG, watermark="40 days").awaitTermination()
    return KeyedTable(t.spark, path).read().select(*_COLUMNS)


def output_stream(t):
    return t.spark.sql(fx.OUTPUTS, events=event_stream(t))


_WINDOW = """SELECT strftime(time_bucket(INTERVAL 1 HOUR, classified_at), '%Y-%m-%d %H:%M:%S') AS window_start, field_name,
  mapping_status, count(*) AS n_rows FROM fx_outputs GROUP BY ALL"""


@reg("status_windows", "T2", _WINDOW, "fx_outputs")
def _(t):
    df = mapper.status_windows(output_stream(t), watermark="2 days")
    table = mapper.run_to_table(df, target(t, "windows"), ["window_start", "window_end", "field_name", "mapping_status"])
    return table.read().select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "field_name", "mapping_status", "n_rows"
    )


@reg("anomaly_state", "T3", """SELECT field_name, normalized_label FROM fx_outputs
    WHERE mapping_status IN ('TRUE_ANOMALY', 'KNOWN_TRUE_ANOMALY') AND normalized_label <> '' GROUP BY ALL
    HAVING count(DISTINCT source_record_id) >= CASE field_name WHEN 'coaching_tags' THEN 3 WHEN 'additional_tags' THEN 20 ELSE 10 END
      OR count(*) >= CASE field_name WHEN 'coaching_tags' THEN 5 WHEN 'additional_tags' THEN 50 ELSE 25 END
      OR count(DISTINCT date_trunc('week', classified_at)) >= 2""", "fx_outputs")
def _(t):
    out = anomaly_state.anomaly_state(output_stream(t))
    return mapper.run_to_table(out, target(t, "anomalies"), ["field_name", "normalized_label"], mode="append").read()


