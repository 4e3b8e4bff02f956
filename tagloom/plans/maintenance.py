"""The weekly run and the backfill run."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.embedtext import embedding_text
from ..lineage import cut
from ..operators import backfill as B
from ..operators import centroids as C
from ..operators import mapping as M
from ..operators import weekly as W
from ..operators.embedding import Provider, embed
from ..operators.labels import discover_labels
from ..sources.keyed import KeyedTable


def apply_repairs(plan: DataFrame, state: W.State) -> tuple[DataFrame, W.State]:
    """(repairs with rows_affected and status, state): reactivate, rebuild centroids, restore names, in this order.

    A repair is DONE if it changed rows, else NOOP; a blocked one stays blocked. Fields that are not approved count
    one row, that of the mapper's field configuration.
    """
    plan = cut(plan)

    def fields_of(action: str) -> DataFrame:
        return plan.filter(F.col("repair_action") == action).select("field_name").distinct()

    def affected(changed: DataFrame, action: str) -> DataFrame:
        n = changed.groupBy("field_name").agg(F.count("*").alias("n"))
        return n.select("field_name", F.lit(action).alias("repair_action"), "n")

    reactivate, rebuild, restore = (
        "REACTIVATE_LATEST_VALID_STANDARD_CLUSTERS", "REBUILD_MISSING_CENTROIDS_AND_MEDOIDS",
        "RESTORE_MISSING_NAMES_FROM_APPROVED_CLUSTER_METADATA")
    before = cut(state.clusters).alias("o")
    marked = fields_of(reactivate).withColumn("_wanted", F.lit(True))
    awake = W.reactivate_latest(before).withColumnRenamed("active", "_active").join(marked, "field_name", "left")
    awake = cut(awake.select("field_name", "cluster_id", "run_id", "cluster_version", "_active", "_wanted"))
    hit = F.coalesce("_wanted", F.lit(False)) & F.col("_active") & ~F.coalesce("active", F.lit(True))
    key = ["field_name", "cluster_id", "run_id", "cluster_version"]
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"a.{k}")) for k in key]
    both = cut(before.join(awake.alias("a"), same).select("o.*", "a._active", "a._wanted"))
    done = [affected(both.filter(hit), reactivate)]
    clusters = both.withColumn("active", F.when(hit, F.lit(True)).otherwise(F.col("active"))).drop("_active", "_wanted")
    clusters, rebuilt = C.rebuild_missing_centroids(clusters, state.label_map, state.embeddings, fields_of(rebuild))
    clusters = cut(clusters)
    done.append(affected(rebuilt, rebuild))
    found = W.missing_names(clusters.join(fields_of(restore), "field_name", "left_semi"), state.names)
    done.append(affected(found, restore))
    names = state.names.unionByName(found, allowMissingColumns=True).select(*state.names.columns)
    counts = reduce(DataFrame.unionByName, done)
    off = F.col("repair_action") == "DISABLE_FROM_PRODUCTION_MAPPER_FIELD_CONFIG"
    rows = F.when(off, F.lit(1)).otherwise(F.coalesce("n", F.lit(0))).cast("bigint")
    repairs = plan.join(counts, ["field_name", "repair_action"], "left").withColumn("rows_affected", rows).drop("n")
    status = F.when(F.col("repair_status") == "BLOCKED", "BLOCKED").when(F.col("rows_affected") > 0, "DONE").otherwise("NOOP")
    return cut(repairs.withColumn("repair_status", status)), W.State(clusters, names, state.label_map, state.outputs, state.embeddings)


def weekly_run(state: W.State, config: DataFrame, start, end, apply: bool = False) -> tuple[DataFrame, DataFrame, W.State]:
    """(repairs, resolver plan, state). A dry run computes the plans and changes nothing.

    Groups may attach to anomaly clusters that larger groups of the same run make.
    """
    counts = W.cluster_counts(state.clusters)
    repairs = W.repair_plan(W.config_issue_fields(state.outputs, start, end), counts, config)
    repairs = repairs.withColumn("rows_affected", F.lit(0).cast("bigint"))
    if apply:
        repairs, state = apply_repairs(repairs.drop("rows_affected"), state)
    targets = M.cluster_targets(state.clusters, state.names)
    plan = cut(W.resolve_plan(state.outputs, targets, state.clusters, start, end, same_run=True))
    if not apply:
        return repairs, plan, state
    label_map, outputs = W.map_to_existing(plan, state.label_map, state.outputs)
    state = W.State(state.clusters, state.names, label_map, outputs, state.embeddings)
    state = W.upsert_anomaly_clusters(plan, state, start, end)
    ready = state.clusters.filter("promotion_status = 'STANDARD_CLUSTER_PROMOTION_CANDIDATE'").select(
        "field_name", "cluster_id", F.col("display_name").alias("proposed"), F.col("medoid_label").alias("representative")
    )
    state, _ = W.promote(state, ready)
    return repairs, plan, state


def apply_to_outputs(plan: DataFrame, label_map: DataFrame, outputs: KeyedTable) -> None:
    """The plan's changes to a table of outputs in buckets by label: only the buckets of planned labels are read and written."""
    plan = cut(plan)

    def change(rows: DataFrame) -> DataFrame:
        return W.mark_anomaly_outputs(plan, W.map_to_existing(plan, label_map, rows)[1])

    outputs.update(plan.select(*W.GROUP), change)


@dataclass(frozen=True)
class BackfillRun:
    decisions: DataFrame
    rows: DataFrame
    counts: DataFrame
    audit: DataFrame
    queue: DataFrame
    state: B.TaxonomyState


def backfill_run(stage: DataFrame, fields: list[str], state: B.TaxonomyState, history: DataFrame, run_id: str,
                 provider: Provider | None = None, dim: int = 384) -> BackfillRun:
    """Discover, match, decide, name, materialize, and only then rewrite and audit; nothing is written here."""
    groups = cut(B.label_groups(discover_labels(stage, fields)))
    refs = cut(B.cluster_refs(state.clusters, state.names))
    matched = cut(B.exact_decisions(groups, B.exact_index(refs, state.label_map)))
    rest = matched.filter("ref IS NULL").select(
        "field_name", "normalized_label", "raw_label", F.concat_ws("|", "field_name", "normalized_label").alias("label_id"),
        embedding_text(F.col("field_name"), F.col("raw_label"), style="backfill").alias("text"),
    )
    rest = cut(embed(rest, "text", provider, dim))
    semantic = M.semantic_match(rest, M.cluster_targets(state.clusters, state.names))
    runs = B.active_run_ids(groups, state.label_map, run_id)
    decided = B.with_embeddings(B.decide(matched, semantic, refs, history, runs, run_id), rest, refs)
    decisions = cut(B.resolve_decision_names(decided, state.names, state.clusters))
    after = B.materialize(decisions, state)
    updates = cut(B.cell_updates(stage, decisions, fields))
    return BackfillRun(
        decisions, B.updated_rows(stage, updates, fields), B.update_counts(stage, updates),
        B.field_audit(decisions, run_id), B.queue_rows(decisions, True), after,
    )
