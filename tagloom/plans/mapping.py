"""The mapping run: calls to labels, exact keys, then vectors for what is left."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.embedtext import embedding_text
from ..functions.keys import dedupe_key
from ..functions.lists import CANDIDATE_THRESHOLD, LABEL_FIELDS
from ..lineage import cut
from ..operators import mapping as M
from ..operators.embedding import Provider, cached_embeddings, embed
from ..operators.labels import explode_calls
from ..skew import join_one


@dataclass(frozen=True)
class Taxonomy:
    clusters: DataFrame
    names: DataFrame
    label_map: DataFrame


@dataclass(frozen=True)
class MapperConfig:
    source_db: str = "calls"
    source_table: str = "calls"
    id_column: str | None = "call_id"
    created: str = "created_at"
    fields: list[str] = field(default_factory=lambda: list(LABEL_FIELDS))
    dim: int = 384
    text_mode: str = "field_label"
    unique_ids: bool = False
    model: str = "hash-sha256"
    overrides: dict | None = None
    cache: DataFrame | None = None
    cache_key: str = ""


#: What a mapped label carries besides its key; the weekly job reads candidates and vector.
STATUS = [
    "embedding_text", "label_embedding", "mapped_cluster_id", "mapped_cluster_name", "mapped_display_name", "similarity_score",
    "existing_cluster_threshold", "new_cluster_candidate_threshold", "mapping_status", "mapping_method", "cluster_version",
    "top_candidates", "embedding_model", "text_mode",
]


def map_labels(labels: DataFrame, taxonomy: Taxonomy, provider: Provider | None = None,
               config: MapperConfig = MapperConfig()) -> DataFrame:
    """Status of distinct labels (field_name, raw_label, normalized_label).

    Exact keys are resolved first; only labels without one are embedded (or taken from the cache of vectors) and
    compared. Columns: the key and STATUS; exact rows have no text, vector or candidates.
    """
    state = (taxonomy.label_map, taxonomy.clusters, taxonomy.names)
    std, anom = (M.load_exact_map(*state, anomaly=a) for a in (False, True))
    matched = cut(M.exact_map_join(labels, std, anom))
    rest = matched.filter("exact_cluster_id IS NULL").select("field_name", "raw_label", "normalized_label")
    text = embedding_text(F.col("field_name"), F.col("raw_label"), config.text_mode)
    rest = rest.withColumn("embedding_text", text)
    if config.cache is None:
        rest = embed(rest, "embedding_text", provider, config.dim)
    else:
        rest = cached_embeddings(rest, config.cache, config.cache_key, provider, config.dim, config.text_mode).drop("from_cache")
    rest = cut(rest.withColumn("label_id", F.concat_ws("|", "field_name", "raw_label")))
    targets = M.cluster_targets(taxonomy.clusters, taxonomy.names, config.overrides)
    status = M.mapping_status(rest, M.rank_candidates(rest, targets), targets).withColumn("label_embedding", F.col("embedding"))
    kinds = {f.name: f.dataType for f in status.schema}
    none = {c: F.lit(None).cast(kinds[c]) for c in ("embedding_text", "label_embedding")}
    empty = F.array().cast(kinds["top_candidates"])
    exact = M.exact_status(matched.filter("exact_cluster_id IS NOT NULL")).withColumns(none | {"top_candidates": empty})

    def whole(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "mapped_cluster_name": F.col("mapped_display_name"),
            "new_cluster_candidate_threshold": F.lit(CANDIDATE_THRESHOLD),
            "embedding_model": F.lit(config.model), "text_mode": F.lit(config.text_mode),
        }).select("field_name", "raw_label", "normalized_label", *STATUS)

    return whole(exact).unionByName(whole(status))


def with_key(rows: DataFrame) -> DataFrame:
    """Add the dedupe key, which holds the version of the cluster that was mapped; one key for stream and batch."""
    parts = [F.col(c) for c in ("source_db", "source_table", "source_record_id", "field_name",
                                "normalized_label", "cluster_version")]
    return rows.withColumn("dedupe_key", dedupe_key(*parts))


def run_mapping(calls: DataFrame, taxonomy: Taxonomy, run_id: str, provider: Provider | None = None,
                config: MapperConfig = MapperConfig()) -> DataFrame:
    """One output row per record, field and normalized label, keyed by its dedupe key."""
    exploded = cut(explode_calls(  # read for its distinct labels and again for its rows, parsed once
        calls, config.fields, config.source_db, config.source_table, config.id_column, config.created,
        unique_ids=config.unique_ids,
    ))
    keys = ["field_name", "raw_label", "normalized_label"]
    counts = cut(exploded.groupBy(*keys).agg(F.count("*").alias("_n")))
    status = cut(map_labels(counts.select(*keys), taxonomy, provider, config))
    out = with_key(join_one(exploded, status, keys, "inner", counts))  # the commonest label may hold any share of the rows
    return out.withColumns({"mapper_run_id": F.lit(run_id), "created_at": F.current_timestamp()})
