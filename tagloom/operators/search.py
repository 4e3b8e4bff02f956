"""Search over label vectors, similar clusters, and the calls behind a label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands
from ..functions import vectors as V
from ..functions.text import normalize_label, parse_call_label
from .mapping import is_active, is_anomaly, with_names
from .reports import named_clusters, of_run
from .vector_index import VectorIndex


def similar_clusters(clusters: DataFrame, names: DataFrame, cluster_pk: int, k: int = 8) -> DataFrame:
    """Clusters nearest to one cluster, over all fields, with band and mean similarity."""
    one = clusters.filter((F.col("id") == cluster_pk) & F.col("centroid_embedding").isNotNull()).select(
        F.col("field_name").alias("_f"), is_anomaly().alias("_a"), F.col("centroid_embedding").alias("_v")
    )
    c = named_clusters(clusters.filter((F.col("id") != cluster_pk) & F.col("centroid_embedding").isNotNull()), names)
    score = V.cosine(F.col("centroid_embedding"), F.col("_v"))
    same = F.col("field_name") == F.col("_f")
    top = (
        c.join(F.broadcast(one))  # one row
        .withColumns({"_score": score, "same_field": same})
        .filter("_score IS NOT NULL")
        .withColumns({
            "cosine_similarity": F.round("_score", 4),
            "interpretation": bands.similarity_band(F.col("_score"), F.col("same_field"), F.col("_a")),
        })
        .orderBy(F.col("cosine_similarity").desc(), "id").limit(min(k, 20))
    )
    mean = top.agg(F.round(F.avg("cosine_similarity"), 4).alias("mean_similarity"))
    return top.drop("_f", "_a", "_v", "_score").join(F.broadcast(mean))


def label_hits_to_map(hits: DataFrame, label_map: DataFrame) -> DataFrame:
    """Map rows of the field whose raw OR normalized label equals the hit's.

    Two equi-joins instead of an OR join; a map row that matches both ways counts once.
    ``hits`` has a unique ``hit_id``.
    """
    m = label_map.select(
        "field_name", F.col("raw_label").alias("map_raw"), F.col("normalized_label").alias("map_norm"),
        "run_id", "final_cluster_id", "value_count", "cluster_version",
    )
    by_raw = hits.join(m.withColumn("raw_label", F.col("map_raw")), ["field_name", "raw_label"])
    by_norm = hits.join(m.withColumn("normalized_label", F.col("map_norm")), ["field_name", "normalized_label"])
    columns = ["hit_id", "field_name", "similarity", "map_raw", "map_norm", "run_id", "final_cluster_id",
               "value_count", "cluster_version"]
    return by_raw.select(*columns).unionByName(by_norm.select(*columns)).dropDuplicates(
        ["hit_id", "field_name", "map_raw", "map_norm", "run_id", "final_cluster_id"]
    )


def call_samples(pairs: DataFrame, outputs: DataFrame, run: str | None = None, n: int = 8) -> DataFrame:
    """Rows, distinct calls, latest time and last ``n`` call ids of each (field, cluster)."""
    keys = ["field_name", "cluster_id"]
    matched = (
        of_run(outputs, run).filter("mapping_status = 'EXISTING_CLUSTER' AND source_record_id IS NOT NULL")
        .withColumnRenamed("mapped_cluster_id", "cluster_id")
        .join(pairs.select(*keys).distinct(), keys, "left_semi")
    )
    numbers = matched.groupBy(*keys).agg(
        F.count("*").alias("production_rows"), F.countDistinct("source_record_id").alias("distinct_call_count"),
        F.max("classified_at").alias("latest_classified_at"),
    )
    w = Window.partitionBy(*keys).orderBy(F.col("classified_at").desc_nulls_last(), "source_record_id")
    ids = (
        matched.select(*keys, "source_record_id", "classified_at").distinct()
        .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
        .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_rn", "source_record_id")))
                            .getField("source_record_id").alias("sample_call_ids"))
    )
    return pairs.join(numbers, keys, "left").join(ids, keys, "left")


def call_evidence(calls: DataFrame, transcripts: DataFrame, field: str, label: str, limit: int = 25) -> DataFrame:
    """Newest calls that carry a label: equal for a text field, all values for an array."""
    values = parse_call_label(F.lit(label.strip()))["values"]
    kind = calls.schema[field].dataType.typeName()
    if kind == "array":
        test = F.size(F.array_except(values, F.col(field))) == 0
    else:
        test = F.col(field) == F.get(values, F.lit(0))
    top = (
        calls.filter(test & (F.col("sequence") == 1))
        .orderBy(F.col("call_date_time").desc(), "call_id").limit(max(1, min(limit, 100)))
    )
    text = F.col("transcript")
    return top.join(transcripts, "call_id", "left").select(
        "call_id", "call_date_time", "created_at", "agent_name",
        F.substring(text, 1, 400).alias("transcript_preview"),
        (text.isNotNull() & (F.length(text) > 400)).alias("full_transcript_available"),
    )


def _cluster_hits(mapped: DataFrame, keys: list[str], best_label_n: int = 8) -> DataFrame:
    w = Window.partitionBy("field_name", "cluster_id").orderBy(
        F.col("similarity").desc_nulls_last(), F.col("value_count").desc_nulls_last(), "map_raw", "map_norm", "hit_id"
    )
    ranked = mapped.withColumn("rn", F.row_number().over(w))
    entry = F.when(F.col("rn") <= best_label_n, F.struct("rn", F.col("map_raw").alias("raw_label"),
                                                        F.round("similarity", 4).alias("similarity"), "value_count"))
    return ranked.groupBy(*keys).agg(
        F.max("similarity").alias("best_label_similarity"), F.avg("similarity").alias("avg_label_similarity"),
        F.count("*").alias("matched_label_count"),
        F.sum(F.coalesce("value_count", F.lit(1))).alias("matched_occurrences"),
        F.max(F.when(F.col("rn") == 1, F.col("map_raw"))).alias("best_label"),
        F.array_sort(F.collect_list(entry)).alias("matched_labels"),
    )


def semantic_search(
    query: DataFrame, embeddings: DataFrame | VectorIndex, label_map: DataFrame, clusters: DataFrame, names: DataFrame,
    field: str | None = None, label_limit: int | None = None, min_score: float = 0.34, limit: int = 60,
) -> DataFrame:
    """Clusters of the labels nearest to the query vector (``query`` is one row with ``q``).

    Score = 0.78 best + 0.22 mean similarity of the cluster's matched labels: those of at least ``min_score``, or the
    ``label_limit`` nearest of them. ``embeddings`` may be an index of them, of which only the cells in reach are read.
    """
    columns = ["field_name", "raw_label", "normalized_label", "similarity"]
    if isinstance(embeddings, VectorIndex):
        one = query.select(F.lit("q").alias("id"), "q")
        found = embeddings.search(one, "id", "q", min_sim=min_score)
        hits = found.select("row.field_name", "row.raw_label", "row.normalized_label", F.col("sim").alias("similarity"))
    else:
        sim = V.cosine(V.as_double(F.col("embedding")), V.as_double(F.col("q")))
        hits = (
            embeddings.filter(F.col("embedding").isNotNull()).join(F.broadcast(query.select("q")))  # one row
            .withColumn("similarity", F.round(sim, 9)).filter("similarity IS NOT NULL")
            .select(*columns).filter(F.col("similarity") >= min_score)
        )
    if field:
        hits = hits.filter(F.col("field_name") == field)
    hits = hits.withColumn("hit_id", F.concat_ws("|", "field_name", "raw_label"))
    if label_limit is not None:
        hits = hits.orderBy(F.col("similarity").desc(), "field_name", "raw_label").limit(label_limit)
    mapped = label_hits_to_map(hits, label_map).filter("final_cluster_id IS NOT NULL").withColumnRenamed(
        "final_cluster_id", "cluster_id"
    )
    per = _cluster_hits(mapped, ["field_name", "run_id", "cluster_id"])
    score = F.col("best_label_similarity") * 0.78 + F.col("avg_label_similarity") * 0.22
    c = with_names(clusters.filter(is_active()), names, "strict")
    return (
        per.withColumn("_score", score).filter(F.col("_score") >= min_score)
        .join(c, ["field_name", "run_id", "cluster_id"])
        .withColumn("semantic_score", F.round("_score", 4)).drop("_score")
        .orderBy(F.col("semantic_score").desc(), F.col("best_label_similarity").desc(),
                 F.coalesce("total_occurrences", F.lit(0)).desc(), "id")
        .limit(limit)
    )


def token_overlap(query: Column, document: Column) -> Column:
    """Default re-ranker: share of the query's words that the document has."""
    def words(c: Column) -> Column:
        return F.array_distinct(F.split(normalize_label(c, "cluster"), "[^a-z0-9]+"))

    q = words(query)
    return F.size(F.array_intersect(q, words(document))) / F.size(q)


def reranked_search(
    query: DataFrame, documents: DataFrame | VectorIndex, clusters: DataFrame, field: str | None = None, top_k: int = 200,
    min_score: float = 0.3, limit: int = 60, scorer=token_overlap,
) -> DataFrame:
    """Top ``top_k`` documents by inner product, re-scored, grouped by cluster; best score wins.

    ``query`` is one row with ``q`` and ``query_text``. ``documents`` has field_name,
    cluster_id, cluster_version, raw_label, search_text, value_count and embedding. The
    field filter runs before the retrieval, so that the ``top_k`` are all of the field. ``scorer`` maps two text
    columns to a score, a pandas UDF around a model will do. ``documents`` may be an index of them, if their vectors and
    ``q`` are unit vectors and its rows are of the field.
    """
    if isinstance(documents, VectorIndex):
        if field is not None:
            raise ValueError("index the documents of the field: the best of all may hold too few of it")
        found = documents.search(query.select(F.lit("q").alias("id"), "q"), "id", "q", k=top_k)
        top = found.select("row.*", F.col("sim").alias("retrieval")).join(F.broadcast(query.select("query_text")))  # one row
    else:
        score = V.dot(V.as_double(F.col("embedding")), V.as_double(F.col("q")))
        top = (
            (documents if field is None else documents.filter(F.col("field_name") == field))
            .filter(F.col("embedding").isNotNull()).join(F.broadcast(query.select("q", "query_text")))  # one row
            .withColumn("retrieval", F.round(score, 9))
            .orderBy(F.col("retrieval").desc(), "field_name", "raw_label").limit(top_k)
        )
    keys = ["field_name", "cluster_id", "cluster_version"]
    scored = top.withColumn("similarity", F.round(scorer(F.col("query_text"), F.col("search_text")).cast("double"), 6))
    order = F.struct((-F.col("similarity")).alias("s"), (-F.col("retrieval")).alias("r"), "raw_label")
    out = scored.groupBy(*keys).agg(
        F.max("similarity").alias("_best"), F.round(F.avg(F.round("similarity", 4)), 4).alias("avg_label_similarity"),
        F.count("*").alias("matched_label_count"), F.sum(F.coalesce("value_count", F.lit(0))).alias("matched_occurrences"),
        F.min(order).getField("raw_label").alias("semantic_best_label"),
    ).filter(F.col("_best") >= min_score).withColumn("semantic_score", F.round("_best", 4)).drop("_best")
    c = clusters.filter(F.coalesce("active", F.lit(False))).select(
        *keys, "id", "cluster_size", "total_occurrences", "medoid_label")
    return out.join(c, keys, "left").orderBy(F.col("semantic_score").desc(), *keys).limit(limit)
