"""The given tables and the label-shaped tables derived from them, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators.vector_mean import mean_vectors
from . import fixture_sql as fx

GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
DAY0 = 1704067200  # 2024-01-01 00:00:00 UTC


def days_after(n: Column) -> Column:
    return F.timestamp_seconds(F.lit(DAY0) + n * 86400)


class Tables:
    """Lazy access to the tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def given(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        naive = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df

    def _sql(self, text: str, *names: str) -> DataFrame:
        return self.spark.sql(text, **{n: self.given(n) for n in names})

    # calls, stage rows, outputs, runs -------------------------------------------------

    def calls(self) -> DataFrame:
        return self._sql(fx.CALLS, "events", "part")

    def stage(self) -> DataFrame:
        return self._sql(fx.STAGE, "orders")

    def history(self) -> DataFrame:
        return self._sql(fx.HISTORY, "part")

    def proposals(self) -> DataFrame:
        return self._sql(fx.PROPOSALS, "part")

    def representative_texts(self) -> DataFrame:
        return self._sql(fx.REPRESENTATIVES, "part")

    def vector_texts(self) -> DataFrame:
        """Vectors as they come out of a text dump: JSON, braces, broken, empty, not finite."""
        body = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ", ")
        i = F.col("vec_id") % 5
        text = (
            F.when(i == 0, F.concat(F.lit("["), body, F.lit("]")))
            .when(i == 1, F.concat(F.lit("{"), body, F.lit("}")))
            .when(i == 2, F.concat(F.lit("{NaN, "), body, F.lit("}")))
            .when(i == 3, F.lit(" "))
            .otherwise(F.concat(F.lit("["), body))
        )
        return self.given("embeddings").select("vec_id", text.alias("vector_text"))

    def outputs(self) -> DataFrame:
        return self._sql(fx.OUTPUTS, "events").withColumn(
            "similarity_score", F.col("similarity_score").cast("double")
        )

    def outputs_with_candidates(self) -> DataFrame:
        """Outputs with label vectors and up to five candidates of each."""
        out = self.outputs()
        vec = self.label_vectors().select(
            F.col("vec_id").alias("k"), F.col("v").alias("label_embedding")
        )
        k = F.col("k")
        count = F.when(k % 5 == 0, F.lit(1)).otherwise(F.lit(5))
        candidates = F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda j: F.struct(
                F.concat(F.lit("base_"), ((k + j) % 10).cast("string")).alias("cluster_id"),
                ((k - j * 2) / F.lit(100.0)).cast("double").alias("similarity_score"),
                F.concat(F.lit("Display "), ((k + j) % 10).cast("string")).alias("display_name"),
                F.concat(F.lit("Label_"), (k - k % 2).cast("string")).alias("medoid_label"),
                F.lit(0.82).alias("similarity_threshold"),
            ),
        )
        return out.join(vec, "k", "left").withColumn("top_candidates", candidates)

    def transcripts(self) -> DataFrame:
        turns = self.given("conversations").groupBy("conv_id").agg(
            F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t")
        )
        return turns.select(
            F.concat(F.lit("call_"), F.col("conv_id").cast("string")).alias("call_id"),
            F.array_join(F.col("t.text"), " ").alias("transcript"),
        )

    def cluster_runs(self) -> DataFrame:
        df = self._sql(fx.CLUSTER_RUNS, "orders")
        q = F.floor(F.col("n_quarter")).cast("bigint")
        best = F.struct(
            (q / F.col("n_total")).alias("label_recovery_rate"), F.lit(0.82).alias("similarity_threshold"),
            F.lit(15).alias("k_neighbors"), q.alias("graph_communities_found"),
        )
        strict = F.struct(
            (F.col("n_total") - q).alias("recovered_labels"), q.alias("true_anomaly_labels"), best.alias("best_config")
        )
        report = F.to_json(
            F.struct(
                F.col("n_total").alias("total_labels"), F.lit("hash-384").alias("model"),
                strict.alias("strict_graph_recovery"),
            )
        )
        return df.withColumn("run_report", report).drop("n_total", "n_quarter")

    def backfill_runs(self) -> DataFrame:
        return self._sql(fx.BACKFILL_RUNS, "events")

    def field_audit(self) -> DataFrame:
        return self._sql(fx.FIELD_AUDIT, "events").withColumn(
            "confidence", F.col("confidence").cast("double")
        )

    def row_audit(self) -> DataFrame:
        return self._sql(fx.ROW_AUDIT, "events")

    def queue(self) -> DataFrame:
        """Unresolved queue: one row per field and label of the unresolved outputs."""
        o = self.outputs().filter(
            F.col("mapping_status").isin("TRUE_ANOMALY", "NEW_CLUSTER_CANDIDATE")
            & (F.col("normalized_label") != "")
        )
        k = F.col("k")
        return (
            o.groupBy("field_name", "normalized_label", "k")
            .agg(
                F.count("*").alias("occurrence_count"),
                F.countDistinct("source_record_id").alias("distinct_call_count"),
                F.min("classified_at").alias("first_seen"),
                F.max("classified_at").alias("last_seen"),
            )
            .withColumn(
                "resolver_status",
                F.when(k % 4 == 0, F.lit("MAP_TO_EXISTING"))
                .when(k % 4 == 1, F.lit("ANOMALY"))
                .when(k % 4 == 2, F.lit("PROMOTE")),
            )
            .withColumn(
                "evidence_json",
                F.when(
                    k % 4 != 3,
                    F.concat(
                        F.lit('{"materialized": '),
                        F.when(k % 3 == 0, F.lit("true")).otherwise(F.lit("false")),
                        F.lit("}"),
                    ),
                ),
            )
            .drop("k")
        )

    # vectors, clusters, names, maps -----------------------------------------------------

    def label_vectors(self) -> DataFrame:
        """Vectors blended with an anchor of their cluster, so that all score bands occur."""
        e = self.given("embeddings").select(
            "vec_id",
            "label",
            (F.col("vec_id") % 3).alias("f"),
            V.as_double(F.col("embedding")).alias("e"),
        )
        anchors = e.groupBy("f", "label").agg(F.min_by("e", "vec_id").alias("a"))
        step = F.floor(F.col("vec_id") / 3) % 4
        w = (
            F.when(step == 0, 1.0).when(step == 1, 0.8).when(step == 2, 0.55).otherwise(0.3)
        )
        mixed = F.zip_with("a", "e", lambda a, x: F.col("w") * a + (1 - F.col("w")) * x)
        name = F.col("vec_id").cast("string")
        return (
            e.join(anchors, ["f", "label"])
            .withColumn("w", w)
            .select(
                "vec_id",
                F.concat(F.lit("field_"), F.col("f").cast("string")).alias("field_name"),
                F.concat(F.lit("Label_"), name).alias("raw_label"),
                F.concat(F.lit("label "), name).alias("normalized_label"),
                (1 + F.col("vec_id") % 7).alias("value_count"),
                F.concat(F.lit("base_"), F.col("label").cast("string")).alias("cluster_id"),
                (F.col("label") * 3 + F.col("f")).alias("idx"),
                "w",
                V.l2_normalize(mixed).alias("v"),
            )
        )

    def clusters(self) -> DataFrame:
        lv = self.label_vectors().filter("w >= 0.8")
        keys = ["field_name", "cluster_id", "idx"]
        means = mean_vectors(lv, keys, "v", "value_count")
        medoids = (
            lv.join(means.select(*keys, "mean"), keys)
            .withColumn("sim", F.round(V.cosine(F.col("v"), F.col("mean")), 9))
            .groupBy(*keys)
            .agg(
                F.count("*").alias("cluster_size"),
                F.sum("value_count").alias("total_occurrences"),
                F.min(F.struct(-F.col("sim"), F.col("raw_label"))).alias("m"),
            )
        )
        i = F.col("idx")
        name = i.cast("string")
        return means.join(medoids, keys).select(
            i.cast("bigint").alias("id"),
            F.concat(F.lit("run_"), F.col("field_name")).alias("run_id"),
            "field_name",
            "cluster_id",
            F.when(i % 6 != 5, F.lit("v1")).alias("cluster_version"),
            F.when(i % 7 == 3, "true_anomaly").when(i % 4 == 2, "strict_graph_recovery")
            .otherwise("base_hdbscan").alias("cluster_source"),
            F.when(i % 11 != 4, V.l2_normalize(F.col("mean"))).alias("centroid_embedding"),
            F.col("cluster_size").cast("int").alias("cluster_size"),
            "total_occurrences",
            F.when(i % 5 == 4, F.lit("Misc")).otherwise(F.col("m.raw_label")).alias("medoid_label"),
            F.when(i % 5 == 4, F.lit(None)).otherwise(-F.col("m.col1")).cast("double")
            .alias("medoid_similarity_to_centroid"),
            F.when(i % 7 == 3, F.lit(True)).when(i % 2 == 0, F.lit(False))
            .alias("is_true_anomaly_cluster"),
            F.when(i % 5 != 2, F.lit(0.82)).alias("similarity_threshold"),
            F.when(i % 13 == 6, F.lit(False)).when(i % 4 != 1, F.lit(True)).alias("active"),
            F.when(i % 3 == 1, F.concat(F.lit("Own Name "), name)).alias("display_name"),
            F.when(i % 7 == 3, F.lit("ACTIVE_TRUE_ANOMALY")).alias("promotion_status"),
            days_after(i).alias("created_at"),
            days_after(i * 2).alias("updated_at"),
        )

    def names(self) -> DataFrame:
        """Names of most clusters: some missing, some shared inside a field, some generic."""
        i = F.col("idx")
        name = i.cast("string")
        return (
            self.label_vectors()
            .filter("w >= 0.8")
            .select("field_name", "cluster_id", "idx")
            .distinct()
            .filter(i % 9 != 7)
            .select(
                "field_name",
                "cluster_id",
                F.concat(F.lit("run_"), F.col("field_name")).alias("run_id"),
                F.when(i % 6 != 5, F.lit("v1")).alias("cluster_version"),
                F.when(i % 10 == 0, "Other").when(i % 10 == 7, "Misc")
                .when(i % 8 == 5, "Shared Name")
                .otherwise(F.concat(F.lit("Cluster Name "), name)).alias("display_name"),
                F.lit("deterministic").alias("naming_method"),
                (i % 7 == 3).alias("is_anomaly"),
                F.lit(True).alias("active"),
                days_after(i).alias("created_at"),
                days_after(i).alias("updated_at"),
            )
        )

    def label_map(self) -> DataFrame:
        """Labels with their final cluster; source by how close the label was."""
        w = F.col("w")
        return self.label_vectors().select(
            F.concat(F.lit("run_"), F.col("field_name")).alias("run_id"),
            "field_name",
            "raw_label",
            "normalized_label",
            "value_count",
            F.col("cluster_id").alias("final_cluster_id"),
            F.when(w >= 0.8, "base_hdbscan").when(w >= 0.5, "strict_graph_recovery")
            .otherwise("true_anomaly").alias("final_cluster_source"),
            (w < 0.5).alias("final_is_true_anomaly"),
            F.when(w >= 0.8, F.regexp_replace("cluster_id", "base_", "")).otherwise(F.lit("-1"))
            .alias("base_cluster_id"),
            F.when(F.col("idx") % 6 != 5, F.lit("v1")).alias("cluster_version"),
        )

    def label_embeddings(self) -> DataFrame:
        return self.label_vectors().select(
            F.lit("fields_hash-384_field_label").alias("cache_key"),
            "field_name",
            "raw_label",
            "normalized_label",
            F.col("v").alias("embedding"),
            F.lit("hash-384").alias("model_name"),
        )

    def coordinates(self) -> DataFrame:
        v = F.col("vec_id")
        return self.given("embeddings").select(
            F.concat(F.lit("field_"), (v % 3).cast("string")).alias("field_name"),
            F.concat(F.lit("base_"), F.col("label").cast("string")).alias("cluster_id"),
            F.when(v % 2 == 0, "pca").otherwise("random").alias("projection_method"),
            F.concat(F.lit("run_"), (v % 5).cast("string")).alias("run_id"),
            *[
                F.col("embedding")[n].cast("double").alias(c)
                for n, c in enumerate(("x", "y", "z"))
            ],
            days_after(v).alias("created_at"),
        )
