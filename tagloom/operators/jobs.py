"""Table jobs over label columns: normal forms, texts, names, guards, keys, bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands, embedtext, guards, keys, names, text, vectors
from ..functions.text import pin
from ..lineage import cut


def normalize_table(labels: DataFrame, raw: str = "raw_label") -> DataFrame:
    """The four normal forms, the exact form and the family of each label."""
    c = F.col(raw)
    forms = {
        f"norm_{v}": text.normalize_label(c, v) for v in ("cluster", "mapper", "weekly", "loose")
    }
    return labels.withColumns(
        forms
        | {
            "norm_exact": text.normalize_exact(c),
            "family": text.family_token(c),
            "is_valid": text.valid_label(c),
        }
    )


def embedding_texts(
    labels: DataFrame, mode: str = "field_label", styles: tuple = ("mapper", "backfill", "cluster")
) -> DataFrame:
    """Distinct embedding texts per field and label, one column per style."""
    field, raw = F.col("field_name"), F.col("raw_label")
    return (
        labels.select("field_name", "raw_label")
        .distinct()
        .withColumns({f"text_{s}": embedtext.embedding_text(field, raw, mode, s) for s in styles})
    )


def name_table(proposals: DataFrame, taken: DataFrame | None = None, column: str = "proposed") -> DataFrame:
    """Built and cleaned names, their keys and the validation notes.

    ``taken`` holds existing names in ``display_name``; keys are compared by an equi-join.
    """
    c = F.col(column)
    df = proposals.withColumns(
        {
            "display_weekly": names.display_name(c, job="weekly"),
            "display_backfill": names.display_name(c, job="backfill"),
            "clean_weekly": names.sanitize_name(c, job="weekly"),
            "clean_backfill": names.sanitize_name(c, job="backfill"),
        }
    ).withColumns(
        {
            "key": names.name_key(F.col("clean_weekly")),
            "repeats": names.adjacent_repeat(F.col("clean_weekly")),
            "is_generic": names.generic_name(F.col("clean_weekly")),
            "is_weak_medoid": names.weak_medoid(c),
        }
    )
    if taken is None:
        exists = F.lit(False)
    else:
        key = names.name_key(F.col("display_name"))
        df = df.join(taken.select(key.alias("key")).distinct().withColumn("_t", F.lit(True)), "key", "left")
        exists = F.col("_t").isNotNull()
    return df.withColumn("notes", names.name_notes(c, exists)).drop("_t")


def guard_pairs(labels: DataFrame, clusters: DataFrame, variant: str = "mapper") -> DataFrame:
    """Label and cluster pairs of a field that a guard forbids.

    Masks are computed once per text and grouped, the test runs on distinct mask pairs,
    and only forbidden pairs are ever expanded to labels and clusters.
    """

    def masked(df: DataFrame, column: str, suffix: str) -> DataFrame:
        norm = text.normalize_label(F.col(column), variant)
        opp, act = f"opp_{suffix}", f"act_{suffix}"
        return cut(
            guards.with_masks(pin(df, {"_norm": norm}), "_norm", opp, act)
            .drop("_norm")
            .filter(f"{opp} <> 0 OR {act} <> 0")
        )

    a = masked(labels.select("field_name", "raw_label"), "raw_label", "a")
    b = masked(clusters.select("field_name", "cluster_id", "cluster_text"), "cluster_text", "b")
    kinds_a = a.select("field_name", "opp_a", "act_a").distinct()
    kinds_b = b.select("field_name", "opp_b", "act_b").distinct()
    forbidden = (
        kinds_a.join(kinds_b, "field_name")
        .withColumns(
            {
                "contradiction": guards.masks_contradict(F.col("opp_a"), F.col("opp_b")),
                "actor_conflict": guards.masks_conflict(F.col("act_a"), F.col("act_b")),
            }
        )
        .filter("contradiction OR actor_conflict")
    )
    return (
        forbidden.join(a, ["field_name", "opp_a", "act_a"])
        .join(b, ["field_name", "opp_b", "act_b"])
        .select("field_name", "raw_label", "cluster_id", "contradiction", "actor_conflict")
    )


def relation_table(labels: DataFrame, raw: str = "raw_label", variant: str = "mapper") -> DataFrame:
    """Actor relations, opposite words and content words of each label."""
    df = labels.withColumn("_norm", text.normalize_label(F.col(raw), variant))
    return guards.with_masks(df, "_norm", "opposite_mask", "actor_mask").drop("_norm").withColumns(
        {
            "relations": guards.actor_relations(F.col("actor_mask")),
            "tokens": guards.token_set(F.col(raw)),
        }
    )


def key_table(outputs: DataFrame, model: str, mode: str = "field_label") -> DataFrame:
    """Stable keys of mapper rows."""
    parts = [
        F.col(c)
        for c in (
            "source_db", "source_table", "source_record_id", "field_name", "normalized_label",
            "cluster_version",
        )
    ]
    return outputs.select(
        "event_id",
        keys.dedupe_key(*parts).alias("dedupe_key"),
        keys.old_dedupe_key(*parts).alias("old_key"),
        keys.cluster_id_for("weekly_anom", F.col("field_name"), F.col("normalized_label")).alias(
            "cluster_id"
        ),
        keys.stable_hash(F.col("mapper_run_id"), length=8).alias("run_hash"),
        keys.record_id(None, ["event_id", "field_name", "raw_label"]).alias("record_id"),
        keys.cache_key(F.array("field_name"), model, mode).alias("cache_key"),
    )


def typed_vectors(df: DataFrame, column: str = "vector_text") -> DataFrame:
    """Vectors parsed in the three modes, and the reason a row is rejected."""
    c = F.col(column)
    return df.withColumns(
        {m: vectors.parse_vector(c, m) for m in ("unit", "raw", "drop")}
    ).withColumn(
        "reject",
        F.when(text.strip(c) == "", "empty").when(F.col("unit").isNull(), "not a finite vector"),
    )


def search_documents(label_map: DataFrame, clusters: DataFrame, cluster_names: DataFrame) -> DataFrame:
    """One search text per mapped label; strict version joins."""
    keys_ = ["field_name", "cluster_id", "cluster_version"]
    c = clusters.filter(F.coalesce(F.col("active"), F.lit(False))).select(
        *keys_, "medoid_label", F.col("id").alias("cluster_db_id")
    )
    n = cluster_names.select(*keys_, "display_name")
    return (
        label_map.filter(F.col("final_cluster_id").isNotNull())
        .withColumnRenamed("final_cluster_id", "cluster_id")
        .join(c, keys_, "left")
        .join(n, keys_, "left")
        .withColumn(
            "search_text",
            embedtext.search_document(
                *[F.col(x) for x in ("raw_label", "normalized_label", "display_name",
                                     "medoid_label", "field_name")]
            ),
        )
    )


def band_table(outputs: DataFrame) -> DataFrame:
    """Banded scores of mapper rows and whether the display name changes the label."""
    s = F.col("similarity_score")
    return outputs.withColumns(
        {
            "similarity_band": bands.similarity_band(
                s, F.col("mapped_cluster_id").isNotNull(), F.col("mapping_status") == "KNOWN_TRUE_ANOMALY"
            ),
            "search_confidence": bands.search_confidence(s),
            "label_confidence": bands.label_confidence(s),
            "changed": text.row_changed(F.col("raw_label"), F.col("mapped_display_name")),
        }
    )


def size_band_table(clusters: DataFrame) -> DataFrame:
    return clusters.withColumns(
        {
            "bucket": bands.size_bucket(F.col("cluster_size")),
            "anomaly_type": bands.anomaly_type(F.col("cluster_size")),
        }
    )
