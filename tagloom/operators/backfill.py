"""Backfill: decide every distinct label once, rewrite the rows, audit every change."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.embedtext import embedding_text
from ..functions.keys import cluster_id_for, stable_hash
from ..functions.lists import MULTI_FIELDS
from ..functions.text import normalize_exact, normalize_label, row_changed
from ..functions.vectors import as_double
from ..lineage import cut
from ..skew import join_one
from ..sources.io import latest_per_key, update_or_insert
from .centroids import centroids
from .labels import counted_cells, label_rows, long_cells
from .mapping import is_active, with_names
from .weekly import standard_names

KEY = ["field_name", "normalized_label"]

# What each action writes to the audit and the queue.
FIELD_STATUS = "CHANGED"
MAPPING_METHOD = {
    "MAP_TO_EXISTING_STANDARD": "existing_standard",
    "PROMOTE_EXISTING_ANOMALY_TO_STANDARD": "promoted_anomaly",
    "CREATE_STANDARD_FROM_HISTORICAL_UNRESOLVED": "new_standard_historical",
    "CREATE_TRUE_ANOMALY_NEW_LABEL": "new_anomaly",
}
RESOLVER_STATUS = {
    "MAP_TO_EXISTING_STANDARD": "MAP_TO_EXISTING",
    "PROMOTE_EXISTING_ANOMALY_TO_STANDARD": "PROMOTE",
    "CREATE_STANDARD_FROM_HISTORICAL_UNRESOLVED": "MAP_TO_EXISTING",
    "CREATE_TRUE_ANOMALY_NEW_LABEL": "ANOMALY",
}


def _lookup(values: dict[str, str], c: str) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col(c))


def cluster_refs(clusters: DataFrame, names: DataFrame) -> DataFrame:
    """Active clusters with their shown name; one row per field and cluster, newest first."""
    c = with_names(clusters.filter(is_active()), names, "strict")
    c = latest_per_key(c, ["field_name", "cluster_id"], [F.col("updated_at").desc_nulls_last(), F.col("run_id")])
    source = F.lower(F.coalesce("cluster_source", F.lit("")))
    reps = (
        F.col("representative_labels") if "representative_labels" in c.columns
        else F.array().cast("array<string>")
    )
    return c.select(
        "field_name", "cluster_id", "run_id", "cluster_version",
        F.coalesce("name", "display_name", "cluster_id").alias("display_name"),
        (F.coalesce("is_true_anomaly_cluster", F.lit(False)) | (source == "true_anomaly")).alias("is_anomaly"),
        F.coalesce("cluster_size", F.lit(0)).alias("cluster_size"),
        F.coalesce("total_occurrences", F.lit(0)).alias("total_occurrences"),
        "medoid_label", reps.alias("representative_labels"),
        as_double(F.col("centroid_embedding")).alias("centroid_embedding"),
    )


def exact_index(refs: DataFrame, label_map: DataFrame) -> DataFrame:
    """Best cluster per (field, key); keys are exact and loose forms of names, medoids,
    representatives and mapped labels. Standard clusters win, then occurrences, size, id."""
    ref = F.struct(
        (~F.col("is_anomaly")).alias("standard"), "total_occurrences", "cluster_size", "cluster_id",
        "display_name", "run_id", "cluster_version",
    )
    texts = F.concat(
        F.array("display_name", "medoid_label"),
        F.coalesce("representative_labels", F.array().cast("array<string>")),
    )
    own = refs.select("field_name", ref.alias("ref"), F.explode(texts).alias("text"))
    m = label_map.filter("final_cluster_id IS NOT NULL").select(
        "field_name", F.col("final_cluster_id").alias("cluster_id"), "raw_label", "normalized_label",
        F.col("run_id").alias("_run"), F.col("cluster_version").alias("_version"),
        F.coalesce("final_is_true_anomaly", F.lit(False)).alias("_anomaly"),
    )
    known = refs.select("field_name", "cluster_id", ref.alias("_ref"))
    unlisted = F.struct(
        (~F.col("_anomaly")).alias("standard"), F.lit(0).cast("bigint").alias("total_occurrences"),
        F.lit(0).alias("cluster_size"), "cluster_id", F.col("cluster_id").alias("display_name"),
        F.col("_run").alias("run_id"), F.col("_version").alias("cluster_version"),
    )
    mapped = m.join(known, ["field_name", "cluster_id"], "left").select(
        "field_name", F.coalesce("_ref", unlisted).alias("ref"),
        F.explode(F.array("raw_label", "normalized_label", "_ref.display_name")).alias("text"),
    )
    t = F.col("text")
    keys = F.explode(F.array_distinct(F.array(normalize_exact(t), normalize_label(t, "loose"))))
    best = (
        own.unionByName(mapped)
        .filter("text IS NOT NULL")
        .select("field_name", "ref", keys.alias("key"))
        .filter("key IS NOT NULL AND key <> ''")
        .groupBy("field_name", "key")
        .agg(F.max("ref").alias("ref"))
    )
    return best.select(
        "field_name", "key", "ref.cluster_id", "ref.display_name", "ref.run_id", "ref.cluster_version",
        (~F.col("ref.standard")).alias("is_anomaly"),
    )


def active_run_ids(fields: DataFrame, label_map: DataFrame, default: str,
                   mapper_runs: DataFrame | None = None, run_metadata: DataFrame | None = None) -> DataFrame:
    """Run per field: newest mapper run, else newest run record, else the run most used in
    the label map, else the default. Sources that lack the columns are passed over."""
    found = fields.select("field_name").distinct()
    sources = []
    if mapper_runs is not None and {"field_name", "run_id", "finished_at"} <= set(mapper_runs.columns):
        sources.append(latest_per_key(
            mapper_runs.filter("run_id IS NOT NULL"), ["field_name"],
            [F.col("finished_at").desc_nulls_last(), F.col("run_id")]))
    if run_metadata is not None and {"field_name", "run_id", "created_at"} <= set(run_metadata.columns):
        sources.append(latest_per_key(
            run_metadata.filter("run_id IS NOT NULL"), ["field_name"],
            [F.col("created_at").desc_nulls_last(), F.col("run_id")]))
    used = label_map.filter("run_id IS NOT NULL").groupBy("field_name", "run_id").agg(F.count("*").alias("n"))
    sources.append(latest_per_key(used, ["field_name"], [F.col("n").desc(), F.col("run_id")]))
    for i, s in enumerate(sources):
        found = found.join(s.select("field_name", F.col("run_id").alias(f"_r{i}")), "field_name", "left")
    picks = [F.col(f"_r{i}") for i in range(len(sources))]
    return found.select("field_name", F.coalesce(*picks, F.lit(default)).alias("active_run"))


def label_groups(discovered: DataFrame) -> DataFrame:
    """One row per field and loose normal form: occurrences and the most frequent raw form."""
    return discovered.groupBy(*KEY).agg(
        F.sum("label_count").alias("occurrence_count"),
        F.min(F.struct((-F.col("label_count")).alias("c"), "raw_label")).getField("raw_label").alias("raw_label"),
    )


def exact_decisions(groups: DataFrame, index: DataFrame) -> DataFrame:
    """Groups with ``ref_*`` columns of the exact key of the raw form, else of the normal form."""
    ref = F.struct("cluster_id", "display_name", "run_id", "cluster_version", "is_anomaly")
    by_key = index.select("field_name", "key", ref.alias("r"))
    df = groups.withColumn("_e", normalize_exact(F.col("raw_label")))
    df = df.join(by_key.select("field_name", F.col("key").alias("_e"), F.col("r").alias("_r1")), ["field_name", "_e"], "left")
    df = df.join(
        by_key.select("field_name", F.col("key").alias("normalized_label"), F.col("r").alias("_r2")), KEY, "left"
    )
    return df.withColumn("ref", F.coalesce("_r1", "_r2")).drop("_e", "_r1", "_r2")


def decide(matched: DataFrame, semantic: DataFrame | None, refs: DataFrame, history: DataFrame,
           runs: DataFrame, default_run: str) -> DataFrame:
    """One decision per label.

    Exact match, else accepted semantic match: map to the standard cluster or promote the
    anomaly cluster. Otherwise a label with history becomes a standard cluster, a new one
    a true anomaly.
    """
    df = matched.join(history.select(*KEY, "historical_count"), KEY, "left").join(runs, "field_name", "left")
    if semantic is not None:
        ok = semantic.filter("accepted").select(*KEY, F.col("match_cluster_id").alias("cluster_id"), "best_similarity")
        found = ok.join(
            refs.select("field_name", "cluster_id", "display_name", "run_id", "cluster_version", "is_anomaly"),
            ["field_name", "cluster_id"],
        ).select(*KEY, "best_similarity",
                 F.struct("cluster_id", "display_name", "run_id", "cluster_version", "is_anomaly").alias("_sem"))
        evidence = semantic.select(*KEY, F.col("reason").alias("semantic_reason"))
        df = df.join(found, KEY, "left").join(evidence, KEY, "left")
    else:
        df = df.withColumns({
            "_sem": F.lit(None).cast(df.schema["ref"].dataType),
            "best_similarity": F.lit(None).cast("double"), "semantic_reason": F.lit(None).cast("string"),
        })
    exact = F.col("ref").isNotNull()
    hit = F.coalesce("ref", "_sem")
    run = F.coalesce("active_run", F.lit(default_run))
    history_n = F.coalesce("historical_count", F.lit(0)).cast("bigint")
    field, norm, raw = F.col("field_name"), F.col("normalized_label"), F.col("raw_label")

    def pick(on_anomaly, on_standard, on_history, otherwise):
        return (
            F.when(hit.isNotNull() & hit["is_anomaly"], on_anomaly)
            .when(hit.isNotNull(), on_standard)
            .when(history_n > 0, on_history)
            .otherwise(otherwise)
        )

    made = N.display_name(raw, job="backfill")
    hit_run = F.coalesce(hit["run_id"], run)
    return df.select(
        *KEY, "raw_label",
        pick(
            F.lit("PROMOTE_EXISTING_ANOMALY_TO_STANDARD"), F.lit("MAP_TO_EXISTING_STANDARD"),
            F.lit("CREATE_STANDARD_FROM_HISTORICAL_UNRESOLVED"), F.lit("CREATE_TRUE_ANOMALY_NEW_LABEL"),
        ).alias("action"),
        pick(hit["cluster_id"], hit["cluster_id"], cluster_id_for("clean_std", field, norm),
             cluster_id_for("clean_anom", field, norm)).alias("cluster_id"),
        F.coalesce(hit["display_name"], made).alias("display_name"),
        F.when(hit.isNotNull(), hit_run).otherwise(run).alias("run_id"),
        F.when(hit.isNotNull(), F.coalesce(hit["cluster_version"], hit_run)).otherwise(run).alias("cluster_version"),
        (hit.isNull() & (history_n <= 0)).alias("is_true_anomaly"),
        "occurrence_count", history_n.alias("historical_count"),
        pick(
            F.when(exact, "exact_existing_anomaly_promoted").otherwise("semantic_existing_anomaly_promoted"),
            F.when(exact, "exact_existing_standard").otherwise("semantic_existing_standard"),
            F.lit("historical_unresolved_promoted_to_standard"), F.lit("new_unseen_label_true_anomaly"),
        ).alias("source"),
        F.when(exact, "exact_or_loose_existing_taxonomy_key")
        .when(hit.isNotNull(), "semantic_existing_cluster_centroid").alias("matched_by"),
        F.when(~exact, F.col("best_similarity")).alias("best_similarity"),
        F.when(~exact, F.col("semantic_reason")).alias("semantic_reason"),
        embedding_text(field, raw, style="backfill").alias("embedding_text"),
    )


def resolve_decision_names(decisions: DataFrame, names: DataFrame, clusters: DataFrame) -> DataFrame:
    """Unique names for promoted and new standard clusters: the clean name, else with a hash.

    Of several new clusters with one name in a field the smallest cluster id keeps it.
    """
    needs = F.col("action").isin(
        "PROMOTE_EXISTING_ANOMALY_TO_STANDARD", "CREATE_STANDARD_FROM_HISTORICAL_UNRESOLVED"
    )
    proposed = F.coalesce(
        F.nullif(N.sanitize_name(F.col("display_name"), job="backfill"), F.lit("")),
        N.display_name(F.col("raw_label"), job="backfill"),
    )
    taken = (
        standard_names(names, clusters)
        .select("field_name", N.name_key(F.col("display_name")).alias("_key"), F.col("cluster_id").alias("_o"))
        .groupBy("field_name", "_key").agg(F.min("_o").alias("_lo"), F.max("_o").alias("_hi"))
    )
    df = decisions.withColumn("_p", F.when(needs, proposed)).withColumn("_key", N.name_key(F.col("_p")))
    batch = (
        df.filter(F.col("_p").isNotNull()).groupBy("field_name", "_key")
        .agg(F.min("cluster_id").alias("_first"))
    )
    df = df.join(taken, ["field_name", "_key"], "left").join(batch, ["field_name", "_key"], "left")
    free = (
        F.coalesce((F.col("_lo") == F.col("cluster_id")) & (F.col("_hi") == F.col("cluster_id")), F.lit(True))
        & (F.col("_first") == F.col("cluster_id"))
    )
    hashed = N.sanitize_name(
        F.concat_ws(" ", "_p", stable_hash(F.col("field_name"), F.col("normalized_label"), length=4)), job="backfill"
    )
    return df.withColumns({
        "display_name": F.when(F.col("_p").isNull(), F.col("display_name"))
        .when(free, F.col("_p")).otherwise(F.coalesce(F.nullif(hashed, F.lit("")), "_p")),
        "naming_method": F.when(F.col("_p").isNull(), F.lit(None).cast("string"))
        .when(free, "deterministic_standard_name_fallback")
        .otherwise("deterministic_standard_name_unique_hash_fallback"),
    }).drop("_p", "_key", "_lo", "_hi", "_first")


# -- rows -----------------------------------------------------------------------------------


#: 128 bits of a cell; cells are joined by them and compared where they meet.
_HASHES = ["_h1", "_h2"]


def _with_hashes(cells: DataFrame) -> DataFrame:
    cell = ["field_name", "_cell", "_array"]
    return cells.withColumns({"_h1": F.xxhash64(*cell), "_h2": F.xxhash64(F.lit(1), *cell)})


def _shown_cell() -> Column:
    """The text that stands for a cell, text or array."""
    return F.coalesce("_cell", F.array_join("_array", ", ", ""))


def cell_values(stage: DataFrame, decisions: DataFrame, fields: list[str]) -> DataFrame:
    """New value of each distinct cell that has a decided label: (field_name, _cell, _array, ...).

    A cell is parsed, decided and put together once, however many rows have it; array cells stay arrays.
    """
    cells = cut(_with_hashes(counted_cells(stage, fields).drop("_rows")))
    labels = label_rows(cells, _HASHES, "stage")
    shown = decisions.select(*KEY, F.col("display_name").alias("_shown"))
    mapped = labels.join(shown, KEY, "left").groupBy(*_HASHES, "field_name").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("_shown", "raw_label").alias("label"))))
        .getField("label").alias("_mapped"),
        F.max(F.col("_shown").isNotNull()).alias("_any"),
    ).filter("_any").drop("_any")
    multi = F.col("field_name").isin(MULTI_FIELDS)
    is_array = F.col("_array").isNotNull()
    text = F.when(is_array | multi, F.array_join("_mapped", ", ")).otherwise(F.get("_mapped", F.lit(0)))
    changed = F.when(is_array, ~F.col("_array").eqNullSafe(F.col("_mapped"))).otherwise(row_changed(F.col("old_value"), text))
    return cells.withColumn("old_value", _shown_cell()).join(mapped, [*_HASHES, "field_name"]).select(
        *_HASHES, "field_name", "_cell", "_array", "old_value", text.alias("new_value"),
        F.when(is_array, F.col("_mapped")).alias("new_array"), changed.alias("changed"))


def cell_updates(stage: DataFrame, decisions: DataFrame, fields: list[str], row_id: str = "id") -> DataFrame:
    """New value of each cell that has a decided label, and whether it differs.

    Distinct cells are decided once and joined back to the rows; ``new_array`` is set for array cells, whose texts are
    joined by commas in ``old_value`` and ``new_value``.
    """
    values = cut(cell_values(stage, decisions, fields).withColumnsRenamed({"_cell": "_cell_v", "_array": "_array_v"}))
    cells = long_cells(stage, [F.col(row_id)], fields).filter("_cell IS NOT NULL OR _array IS NOT NULL")
    rows = join_one(_with_hashes(cells), values, ["field_name", *_HASHES], "inner")
    same = F.col("_cell").eqNullSafe(F.col("_cell_v")) & F.col("_array").eqNullSafe(F.col("_array_v"))
    return rows.filter(same).select(row_id, "field_name", "old_value", "new_value", "new_array", "changed")


def apply_to_rows(stage: DataFrame, decisions: DataFrame, fields: list[str], row_id: str = "id") -> DataFrame:
    """Changed rows only, with their new cells and the time of the change; array cells stay arrays."""
    return updated_rows(stage, cell_updates(stage, decisions, fields, row_id), fields, row_id)


def updated_rows(stage: DataFrame, updates: DataFrame, fields: list[str], row_id: str = "id") -> DataFrame:
    """The rows of ``apply_to_rows`` from ``cell_updates`` that are known."""
    updates = updates.filter("changed")
    present = [f for f in fields if f in stage.columns]
    arrays = {f for f in present if stage.schema[f].dataType.typeName() == "array"}
    wide = updates.groupBy(row_id).agg(*[
        F.max(F.when(F.col("field_name") == f, F.col("new_array") if f in arrays else F.col("new_value"))).alias(f"_{f}") for f in present
    ])
    return stage.join(wide, row_id).select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in present else F.col(c) for c in stage.columns],
        F.current_timestamp().alias("better_tags_updated_at"),
    )


def update_counts(stage: DataFrame, updates: DataFrame, row_id: str = "id") -> DataFrame:
    """Scanned, changed and unchanged rows, and changed cells, of a run."""
    changed = updates.groupBy(row_id).agg(F.count_if("changed").alias("cells")).filter("cells > 0")
    c = changed.agg(F.count("*").alias("rows_changed"), F.coalesce(F.sum("cells"), F.lit(0)).alias("cells_changed"))
    s = stage.agg(F.count("*").alias("rows_scanned"))
    return s.join(F.broadcast(c)).withColumn(  # two one-row tables
        "rows_unchanged", F.col("rows_scanned") - F.col("rows_changed")
    )


def write_updates(stage: DataFrame, updates: DataFrame, fields: list[str], path: str, row_id: str = "id") -> DataFrame:
    """Write the changed rows (as ``apply_to_rows``) and return ``update_counts`` of them, both from one pass over the rows."""
    changed = updates.filter("changed")
    present = [f for f in fields if f in stage.columns]
    arrays = {f for f in present if stage.schema[f].dataType.typeName() == "array"}
    wide = changed.groupBy(row_id).agg(F.count("*").alias("_cells"), *[
        F.max(F.when(F.col("field_name") == f, F.col("new_array") if f in arrays else F.col("new_value"))).alias(f"_{f}") for f in present
    ])
    seen = Observation()
    hit = F.col("_cells").isNotNull()
    rows = stage.join(wide, row_id, "left").observe(
        seen, F.count(F.lit(1)).alias("rows_scanned"), F.count_if(hit).alias("rows_changed"),
        F.coalesce(F.sum("_cells"), F.lit(0)).cast("bigint").alias("cells_changed"))
    rows.filter(hit).select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in present else F.col(c) for c in stage.columns],
        F.current_timestamp().alias("better_tags_updated_at")).write.parquet(path)
    n = seen.get
    counts = (n["rows_scanned"], n["rows_changed"], n["cells_changed"], n["rows_scanned"] - n["rows_changed"])
    return stage.sparkSession.createDataFrame([counts], "rows_scanned long, rows_changed long, cells_changed long, rows_unchanged long")


def field_audit(decisions: DataFrame, run_id: str) -> DataFrame:
    return decisions.select(
        F.lit(run_id).alias("backfill_run_id"), "field_name", F.lit(FIELD_STATUS).alias("field_status"),
        F.col("raw_label").alias("old_value"), F.col("display_name").alias("new_value"),
        F.lit(True).alias("changed"),
        F.coalesce(_lookup(MAPPING_METHOD, "action"), "action").alias("mapping_method"),
        F.to_json(F.array_compact(F.array("display_name"))).alias("mapped_display_names"),
        F.col("source").alias("notes"),
    )


def with_embeddings(decisions: DataFrame, labels: DataFrame, refs: DataFrame) -> DataFrame:
    """Decisions with ``embedding``: the label's vector, else the centroid of the cluster it was matched to."""
    own = labels.select(*KEY, F.col("embedding").alias("_own"))
    centre = refs.select("field_name", "cluster_id", F.col("centroid_embedding").alias("_centre"))
    df = decisions.join(own, KEY, "left").join(centre, ["field_name", "cluster_id"], "left")
    return df.withColumn("embedding", F.coalesce("_own", "_centre")).drop("_own", "_centre")


def queue_rows(decisions: DataFrame, applied: bool) -> DataFrame:
    """Rows for the unresolved-label queue, with the guard that blocked a match."""
    accepted = F.col("semantic_reason") == "accepted_semantic_match"

    def blocked(reason: str) -> Column:
        return F.when(F.col("semantic_reason") == reason, F.lit("blocked"))

    evidence = F.to_json(F.struct(
        F.lit(applied).alias("materialized"), "action", "cluster_id", "source"))
    return decisions.select(
        "field_name", "raw_label", "normalized_label",
        F.greatest(F.lit(1), F.col("occurrence_count")).alias("occurrence_count"),
        _lookup(RESOLVER_STATUS, "action").alias("resolver_status"),
        F.col("cluster_id").alias("target_cluster_id"), F.col("display_name").alias("target_display_name"),
        F.when(accepted, F.round("best_similarity", 4)).alias("similarity_score"),
        blocked("actor_direction_conflict").alias("actor_guard_status"),
        blocked("contradiction_guard_blocked").alias("contradiction_guard_status"),
        evidence.alias("evidence_json"),
    )


# -- state ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class TaxonomyState:
    clusters: DataFrame
    names: DataFrame
    label_map: DataFrame
    embeddings: DataFrame


def materialize(decisions: DataFrame, state: TaxonomyState) -> TaxonomyState:
    """State after the decisions: vectors, promoted and new clusters, names, label map, and
    new centroids of the touched clusters. ``decisions`` carries ``embedding``; names are resolved if they are not yet."""
    ckey = ["field_name", "cluster_id"]
    resolved = "naming_method" in decisions.columns
    d = cut(decisions if resolved else resolve_decision_names(decisions, state.names, state.clusters))
    embeddings = update_or_insert(
        state.embeddings,
        d.filter("embedding IS NOT NULL").select("field_name", "raw_label", "normalized_label", "embedding"), KEY,
    )
    is_promote = F.col("action") == "PROMOTE_EXISTING_ANOMALY_TO_STANDARD"
    per_cluster = latest_per_key(d, ckey, [F.col("occurrence_count").desc(), F.col("normalized_label")])
    changed = per_cluster.filter(F.col("action") != "MAP_TO_EXISTING_STANDARD")
    promote = changed.filter(is_promote).select(
        *ckey, "run_id", "cluster_version", "display_name",
        F.lit("promoted_existing_anomaly_to_standard").alias("cluster_source"),
        F.lit(False).alias("is_true_anomaly_cluster"), F.lit(True).alias("active"),
        F.lit("PROMOTED_TO_STANDARD").alias("promotion_status"),
    )
    create = changed.filter(~is_promote).select(
        *ckey, "run_id", "cluster_version", "display_name",
        F.when(F.col("is_true_anomaly"), "clean_true_anomaly").otherwise("clean_historical_standard").alias("cluster_source"),
        F.col("embedding").alias("centroid_embedding"), F.col("raw_label").alias("medoid_label"),
        F.when(F.col("embedding").isNotNull(), F.lit(1.0)).alias("medoid_similarity_to_centroid"),
        F.lit(1).alias("cluster_size"), F.greatest(F.lit(1), F.col("occurrence_count")).alias("total_occurrences"),
        F.col("is_true_anomaly").alias("is_true_anomaly_cluster"), F.lit(True).alias("active"),
        F.when(F.col("is_true_anomaly"), "ACTIVE_TRUE_ANOMALY").otherwise("PROMOTED_TO_STANDARD").alias("promotion_status"),
    )
    clusters = update_or_insert(update_or_insert(state.clusters, promote, ckey), create, ckey)
    names = update_or_insert(
        state.names,
        changed.select(*ckey, "run_id", "cluster_version", "display_name",
                       F.coalesce("naming_method", F.lit("deterministic_true_anomaly_name")).alias("naming_method"),
                       F.col("is_true_anomaly").alias("is_anomaly"), F.lit(True).alias("active")),
        ckey,
    )
    label_map = update_or_insert(
        state.label_map,
        d.select("run_id", *KEY, "raw_label", F.col("occurrence_count").alias("value_count"),
                 F.col("cluster_id").alias("final_cluster_id"), F.col("source").alias("final_cluster_source"),
                 F.col("is_true_anomaly").alias("final_is_true_anomaly"), "cluster_version"),
        KEY,
    )
    touched = d.select(*ckey).distinct()
    members = (
        label_map.withColumnRenamed("final_cluster_id", "cluster_id")
        .join(touched, ckey, "left_semi")
        .join(embeddings.select(*KEY, "embedding"), KEY)
        .select(*ckey, "raw_label", "value_count", "embedding")
    )
    rebuilt = centroids(members, "backfill", ckey).select(
        *ckey, F.col("centroid").alias("centroid_embedding"), "medoid_label",
        F.col("medoid_similarity").alias("medoid_similarity_to_centroid"),
        F.col("cluster_size").cast("int").alias("cluster_size"), "total_occurrences",
    )
    return TaxonomyState(update_or_insert(clusters, rebuilt, ckey), names, label_map, embeddings)


