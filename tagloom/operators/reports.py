"""Report queries over the taxonomy state, the mapper outputs and the backfill tables.

Every report is one aggregate or one top-n over its tables. Orders are total (ties end at
the id), so that a limit always returns the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands
from ..functions import vectors as V
from ..functions.lists import GENERIC_NAMES
from ..functions.names import generic_name, weak_medoid
from ..sources.io import feed_views, latest_per_key
from ..sources.pages import page
from .mapping import is_anomaly, with_names

MAP_KEY = ["field_name", "run_id", "cluster_id"]


def _rate(part: str | Column, whole: str | Column, digits: int = 3) -> Column:
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))


def label_counts(label_map: DataFrame) -> DataFrame:
    """Distinct raw labels per field, run and cluster."""
    return label_map.groupBy("field_name", "run_id", F.col("final_cluster_id").alias("cluster_id")).agg(
        F.countDistinct("raw_label").alias("label_count")
    )


def field_label_counts(label_map: DataFrame) -> DataFrame:
    return label_map.groupBy("field_name", F.col("final_cluster_id").alias("cluster_id")).agg(
        F.countDistinct("raw_label").alias("label_count")
    )


def named_clusters(clusters: DataFrame, names: DataFrame, keep_all: bool = False) -> DataFrame:
    """Clusters with the strict name in ``name`` and the shown one in ``shown``."""
    return with_names(clusters, names, "strict", keep_all).withColumn(
        "shown", F.coalesce("name", "display_name")
    )


def latest_projection(coordinates: DataFrame, method: str | None = None) -> DataFrame:
    """Newest coordinates per field, cluster and method."""
    if method:
        coordinates = coordinates.filter(F.col("projection_method") == method)
    return latest_per_key(
        coordinates, ["field_name", "cluster_id", "projection_method"],
        [F.col("created_at").desc(), F.col("run_id")],
    )


def cluster_list(
    clusters: DataFrame, names: DataFrame, label_map: DataFrame, coordinates: DataFrame | None = None,
    *, anomaly: bool | None = None, field: str | None = None, search: str | None = None,
    min_size: int | None = None, named: bool | None = None, method: str = "pca",
    limit: int = 50, offset: int = 0,
) -> DataFrame:
    """Filtered, ordered page of clusters with label counts and coordinates."""
    c = clusters
    if anomaly is not None:
        c = c.filter(is_anomaly() == F.lit(anomaly))
    if field:
        c = c.filter(F.col("field_name") == field)
    if min_size:
        c = c.filter(F.col("cluster_size") >= min_size)
    c = named_clusters(c, names)
    if search:
        like = f"%{search}%"
        members = label_map.filter(F.col("raw_label").ilike(like) | F.col("normalized_label").ilike(like))
        hits = members.select(
            "field_name", "run_id", F.col("final_cluster_id").alias("cluster_id"), F.lit(True).alias("_member")
        ).distinct()
        own = [F.coalesce(F.col(x).ilike(like), F.lit(False)) for x in ("cluster_id", "medoid_label", "name")]
        if "representative_labels" in c.columns:
            own.append(F.coalesce(F.array_join("representative_labels", " ").ilike(like), F.lit(False)))
        c = c.join(hits, MAP_KEY, "left").filter(
            reduce(lambda a, b: a | b, own, F.coalesce("_member", F.lit(False)))
        ).drop("_member")
    if named is not None:
        c = c.filter(F.col("name").isNotNull() == F.lit(named))
    c = c.join(label_counts(label_map), MAP_KEY, "left").withColumn(
        "label_count", F.coalesce("label_count", F.lit(0))
    )
    if coordinates is not None:
        spots = latest_projection(coordinates, method).select(
            "field_name", "cluster_id", F.col("x").alias("projection_x"), F.col("y").alias("projection_y"),
            F.col("z").alias("projection_z"),
        )
        c = c.join(spots, ["field_name", "cluster_id"], "left")
    order = [is_anomaly(), F.coalesce("cluster_size", F.lit(0)).desc(), "field_name", "cluster_id", "id"]
    return c.orderBy(*order).offset(offset).limit(limit)


def clusters_by_display(
    clusters: DataFrame, fields: list[str] | None = None, anomaly: bool | None = None, min_size: int = 1
) -> DataFrame:
    df = clusters.filter(F.col("field_name").isin(fields)) if fields else clusters
    if anomaly is not None:
        df = df.filter(is_anomaly() == F.lit(anomaly))
    return df.filter(F.coalesce("cluster_size", F.lit(0)) >= min_size) if min_size > 1 else df


# -- state ----------------------------------------------------------------------------------


def _filled(names: DataFrame) -> DataFrame:
    return names.filter(F.trim(F.coalesce("display_name", F.lit(""))) != "")


def health(clusters: DataFrame, names: DataFrame, label_map: DataFrame, runs: DataFrame) -> DataFrame:
    """One row of totals; the parts are one-row tables."""
    n = latest_per_key(
        names.filter("display_name IS NOT NULL"), ["field_name", "cluster_id"], [F.col("run_id"), F.col("cluster_version")]
    ).select("field_name", "cluster_id", "run_id", "cluster_version", F.lit(True).alias("_n"))
    joined = clusters.join(n, ["field_name", "cluster_id", "run_id", "cluster_version"], "left")
    flag = F.coalesce("is_true_anomaly_cluster", F.lit(False))
    main = joined.agg(
        F.count("*").alias("total_clusters"), F.count("_n").alias("named_clusters"),
        (F.count("*") - F.count("_n")).alias("unnamed_clusters"),
        F.count_if(flag).alias("anomaly_clusters"), F.count_if(~flag).alias("standard_clusters"),
        F.countDistinct("field_name").alias("fields_count"),
        F.count_if(F.col("centroid_embedding").isNull()).alias("centroid_missing_count"),
    )
    groups = _filled(names).groupBy("field_name", "run_id", "cluster_version", "display_name").count()
    duplicates = groups.filter("count > 1").agg(F.count("*").alias("duplicate_names"))
    rows = label_map.agg(F.count("*").alias("total_label_rows"))
    run_count = runs.agg(F.count("*").alias("last_run_count"))
    return reduce(lambda a, b: a.join(F.broadcast(b)), (rows, duplicates, run_count), main)


def projection_stats(coordinates: DataFrame) -> DataFrame:
    ranges = [F.round(f(c), 4).alias(f"{c}_{n}") for c in ("x", "y") for f, n in ((F.min, "min"), (F.max, "max"))]
    return coordinates.groupBy("projection_method").agg(
        F.count("*").alias("row_count"),
        F.countDistinct(F.concat_ws("::", "field_name", "cluster_id")).alias("unique_clusters"),
        *ranges, F.max("created_at").alias("latest_run"),
    )


def fields(clusters: DataFrame) -> DataFrame:
    return clusters.select("field_name").distinct().orderBy("field_name")


def cluster_labels(clusters: DataFrame, label_map: DataFrame, cluster_pk: int, limit: int = 50) -> DataFrame:
    """Labels of one cluster by count; at most 500."""
    key = clusters.filter(F.col("id") == cluster_pk).select("field_name", "run_id", "cluster_id")
    return (
        label_map.withColumnRenamed("final_cluster_id", "cluster_id")
        .join(F.broadcast(key), MAP_KEY)  # one cluster
        .select("raw_label", "normalized_label", "value_count", "final_is_true_anomaly")
        .orderBy(F.col("value_count").desc_nulls_last(), "raw_label")
        .limit(min(limit, 500))
    )


def cluster_detail(clusters: DataFrame, names: DataFrame, runs: DataFrame, cluster_pk: int) -> DataFrame:
    """One cluster with its names and the metadata of its run."""
    one = named_clusters(clusters.filter(F.col("id") == cluster_pk), names)
    meta = latest_metadata(one.select("run_id", "field_name"), runs, clusters)
    return one.join(meta.drop("run_id"), "field_name", "left")


def field_distribution(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("field_name").agg(
        F.count("*").alias("total"), F.count_if("is_true_anomaly_cluster").alias("anomalies"),
        F.sum("cluster_size").alias("total_labels"),
    )


def size_distribution(clusters: DataFrame) -> DataFrame:
    """Clusters per size bucket, grouped by the bucket alone."""
    return (
        clusters.filter("cluster_size IS NOT NULL")
        .groupBy(bands.size_bucket(F.col("cluster_size")).alias("bucket"))
        .agg(F.count("*").alias("n"), F.min("cluster_size").alias("bucket_min"))
        .orderBy("bucket_min")
    )


def anomaly_clusters(clusters: DataFrame, names: DataFrame, label_map: DataFrame, limit: int = 500) -> DataFrame:
    c = named_clusters(clusters.filter(is_anomaly()), names)
    return (
        c.join(label_counts(label_map), MAP_KEY, "left")
        .withColumns({
            "label_count": F.coalesce("label_count", F.lit(0)),
            "anomaly_type": bands.anomaly_type(F.col("cluster_size")),
        })
        .orderBy(F.col("cluster_size").desc(), "id").limit(limit)
    )


def anomaly_by_field(clusters: DataFrame) -> DataFrame:
    return clusters.filter(is_anomaly()).groupBy("field_name").agg(
        F.count("*").alias("anomaly_clusters"),
        F.coalesce(F.sum("cluster_size"), F.lit(0)).alias("anomaly_labels"),
        F.coalesce(F.sum("total_occurrences"), F.lit(0)).alias("anomaly_occurrences"),
    )


def anomaly_totals(clusters: DataFrame) -> DataFrame:
    flag = is_anomaly()
    kind = bands.anomaly_type(F.col("cluster_size"))
    kinds = ("noise", "threshold_failure", "semantic_outlier", "emerging")
    return clusters.agg(
        F.count("*").alias("total_clusters"), F.count_if(flag).alias("anomaly_clusters"),
        F.coalesce(F.sum(F.when(flag, F.col("cluster_size"))), F.lit(0)).alias("anomaly_labels"),
        F.coalesce(F.sum(F.when(flag, F.col("total_occurrences"))), F.lit(0)).alias("anomaly_occurrences"),
        *[F.count_if(flag & (kind == k)).alias(k) for k in kinds],
    ).withColumn("anomaly_rate", F.round(F.col("anomaly_clusters") / F.col("total_clusters"), 6))


def run_timeline(runs: DataFrame, limit: int = 90) -> DataFrame:
    return (
        runs.groupBy(F.to_date("created_at").cast("string").alias("run_date"), "field_name")
        .agg(F.count("*").alias("run_count"))
        .orderBy(F.col("run_date").desc(), "field_name").limit(limit)
    )


def newest_clusters(clusters: DataFrame, names: DataFrame, limit: int = 20) -> DataFrame:
    return named_clusters(clusters, names).orderBy(F.col("created_at").desc(), "id").limit(limit)


def field_stats(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("field_name").agg(
        F.count("*").alias("total_clusters"), F.sum("cluster_size").alias("total_labels"),
        F.max("created_at").alias("last_updated"),
    )


def graph_nodes(clusters: DataFrame, names: DataFrame, field: str | None = None, limit: int = 600) -> DataFrame:
    c = clusters.filter(F.col("field_name") == field) if field else clusters
    size = F.coalesce("cluster_size", F.lit(1))
    return (
        named_clusters(c, names)
        .select(
            "id", F.coalesce("shown", "cluster_id").alias("label"), "field_name", "cluster_id",
            F.greatest(F.lit(1.0), F.sqrt(size) * 0.9).alias("val"), is_anomaly().alias("is_anomaly"),
            size.alias("cluster_size"),
        )
        .orderBy("field_name", F.col("cluster_size").desc(), "id").limit(min(limit, 2000))
    )


def graph_links(nodes: DataFrame, label_map: DataFrame) -> DataFrame:
    """Undirected links from base to final clusters whose ends are both nodes."""
    paths = label_map.filter("base_cluster_id IS NOT NULL AND base_cluster_id <> final_cluster_id").select(
        "field_name", F.col("base_cluster_id").alias("src"), F.col("final_cluster_id").alias("tgt")
    ).distinct()
    a = nodes.select("field_name", F.col("cluster_id").alias("src"), F.col("id").alias("s"))
    b = nodes.select("field_name", F.col("cluster_id").alias("tgt"), F.col("id").alias("t"))
    return (
        paths.join(a, ["field_name", "src"]).join(b, ["field_name", "tgt"]).filter("s <> t")
        .select(F.least("s", "t").alias("source"), F.greatest("s", "t").alias("target")).distinct()
    )


def field_health(clusters: DataFrame, names: DataFrame) -> DataFrame:
    keys = ["field_name", "cluster_id", "run_id", "cluster_version"]
    n = names.filter("display_name IS NOT NULL").select(*keys).distinct().withColumn("_n", F.lit(True))
    return (
        clusters.join(n, keys, "left").groupBy("field_name")
        .agg(
            F.count("*").alias("total_clusters"), F.count("_n").alias("named_clusters"),
            (F.count("*") - F.count("_n")).alias("unnamed_clusters"),
            F.count_if("is_true_anomaly_cluster").alias("anomaly_clusters"),
            F.round(F.avg("cluster_size"), 1).alias("avg_cluster_size"),
            F.max("cluster_size").alias("max_cluster_size"),
        )
        .withColumns({
            "naming_rate": _rate("named_clusters", "total_clusters"),
            "anomaly_rate": _rate("anomaly_clusters", "total_clusters"),
        })
    )


def _field_list() -> Column:
    return F.array_sort(F.collect_set("field_name"))


def duplicate_names(names: DataFrame, limit: int = 50) -> DataFrame:
    return (
        names.filter("display_name <> ''").groupBy("display_name")
        .agg(F.count("*").alias("cluster_count"), _field_list().alias("fields"))
        .filter("cluster_count > 1").orderBy(F.col("cluster_count").desc(), "display_name").limit(limit)
    )


def same_field_duplicates(names: DataFrame, limit: int = 50) -> DataFrame:
    return (
        _filled(names).groupBy("field_name", "run_id", "cluster_version", "display_name")
        .agg(F.count("*").alias("cluster_count")).filter("cluster_count > 1")
        .orderBy(F.col("cluster_count").desc(), "field_name", "display_name", "run_id", "cluster_version").limit(limit)
    )


def cross_field_duplicates(names: DataFrame, limit: int = 50) -> DataFrame:
    return (
        _filled(names).groupBy("display_name")
        .agg(F.countDistinct("field_name").alias("field_count"), F.count("*").alias("cluster_count"),
             _field_list().alias("fields"))
        .filter("field_count > 1")
        .orderBy(F.col("field_count").desc(), F.col("cluster_count").desc(), "display_name").limit(limit)
    )


def insights(clusters: DataFrame, names: DataFrame, label_map: DataFrame) -> DataFrame:
    """Rows of (id, category, severity, value, metric, affected_field, affected_count)."""
    keys = ["field_name", "cluster_id", "run_id", "cluster_version"]

    def rows(df, id_, category, severity, value, metric, field, count):
        return df.select(
            id_.alias("id"), F.lit(category).alias("category"), severity.alias("severity"),
            value.alias("value"), metric.cast("double").alias("metric"),
            field.cast("string").alias("affected_field"), count.cast("bigint").alias("affected_count"),
        )

    def percent(part, whole):
        return F.round(F.col(part) / F.col(whole) * 100).cast("bigint")

    def worst(df, rate, ascending=False):
        r = F.col(rate[0]) / F.col(rate[1])
        return df.orderBy(r.asc() if ascending else r.desc(), "field_name").limit(3)

    def text(*parts):
        return F.concat_ws("", *[p.cast("string") for p in parts])

    f = F.col("field_name")
    none = F.lit(None)
    per = clusters.groupBy("field_name").agg(
        F.count("*").alias("total"), F.count_if("is_true_anomaly_cluster").alias("anom"),
        F.count_if(F.col("centroid_embedding").isNull()).alias("missing"),
    )
    a = worst(per.filter("total >= 3"), ("anom", "total")).filter("anom > 0").withColumn("p", percent("anom", "total"))
    p = F.col("p")
    high = rows(a, text(F.lit("high_anomaly_"), f), "anomaly",
                F.when(p > 30, "critical").when(p > 15, "warning").otherwise("info"),
                text(p, F.lit("%")), p / 100, f, F.col("anom"))
    n = names.filter("display_name IS NOT NULL").select(*keys).distinct().withColumn("_n", F.lit(True))
    cover = clusters.join(n, keys, "left").groupBy("field_name").agg(
        F.count("*").alias("total"), F.count("_n").alias("named")
    ).withColumn("unnamed", F.col("total") - F.col("named"))
    low = worst(cover.filter("total >= 5"), ("named", "total"), True).withColumn("p", percent("unnamed", "total"))
    naming = rows(low.filter("p >= 10"), text(F.lit("low_naming_"), f), "naming",
                  F.when(p > 50, "critical").otherwise("warning"), text(p, F.lit("% unnamed")), p / 100, f, F.col("unnamed"))
    named = named_clusters(clusters, names, keep_all=True).filter("name IS NOT NULL")
    dup = (
        named.filter(~is_anomaly()).filter("name <> ''").groupBy("name", "field_name").count().filter("count > 1")
        .agg(F.countDistinct("name").alias("d"), F.sum(F.col("count") - 1).alias("excess")).filter("d > 0")
    )
    d = F.col("d")
    dups = rows(dup, F.lit("duplicate_names"), "naming",
                F.when(d > 20, "critical").when(d > 5, "warning").otherwise("info"),
                text(d, F.lit(" names")), d, none, F.col("excess"))
    generic = named.filter(generic_name(F.col("name"), 4))
    g = generic.agg(F.count("*").alias("n")).filter("n > 0")
    gen = rows(g, F.lit("generic_names"), "naming", F.when(F.col("n") > 5, "warning").otherwise("info"),
               text(F.col("n"), F.lit(" clusters")), F.col("n"), none, F.col("n"))
    m = per.filter("missing > 0").orderBy(F.col("missing").desc(), "field_name").limit(3).withColumn("p", percent("missing", "total"))
    miss = rows(m, text(F.lit("centroids_"), f), "quality", F.when(p > 30, "critical").otherwise("warning"),
                text(p, F.lit("% missing")), p / 100, f, F.col("missing"))
    tight = (
        clusters.join(field_label_counts(label_map), ["field_name", "cluster_id"], "left")
        .filter((F.col("cluster_size") >= 20) & (F.coalesce("label_count", F.lit(0)) <= 2))
        .agg(F.count("*").alias("n"), F.max(F.struct("cluster_size", -F.col("id"), "field_name")).getField("field_name").alias("field_name"))
        .filter("n > 0")
    )
    over = rows(tight, F.lit("over_compressed"), "quality", F.lit("warning"), text(F.col("n"), F.lit(" clusters")),
                F.col("n"), f, F.col("n"))
    return reduce(DataFrame.unionByName, [high, naming, dups, gen, miss, over])


def review_priorities(clusters: DataFrame, names: DataFrame, label_map: DataFrame,
                      pool: int | None = None, limit: int = 30) -> DataFrame:
    """Scores of all clusters (or of the ``pool`` largest), with reasons; the best ``limit`` are listed."""
    c = named_clusters(clusters, names, keep_all=True).join(
        field_label_counts(label_map), ["field_name", "cluster_id"], "left"
    ).withColumn("label_count", F.coalesce("label_count", F.lit(0)))
    c = c if pool is None else c.orderBy(F.col("cluster_size").desc(), "id", "name").limit(pool)
    name = F.coalesce("name", F.lit(""))
    rules = [
        ("anomaly", 0.35, is_anomaly()),
        ("unnamed", 0.30, name == ""),
        ("generic_name", 0.20, F.lower(name).isin(GENERIC_NAMES)),
        ("over_compressed", 0.25, (F.col("cluster_size") >= 20) & (F.col("label_count") <= 2)),
        ("low_occurrence", 0.15, (F.col("cluster_size") >= 10) & (F.col("total_occurrences") <= 5)),
        ("short_name", 0.10, (name != "") & (F.length(name) <= 3)),
    ]
    score = reduce(lambda a, b: a + b, [F.when(test, F.lit(w)).otherwise(F.lit(0.0)) for _, w, test in rules])
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(r)) for r, _, test in rules]))
    return (
        c.withColumns({"priority_score": F.least(F.lit(1.0), F.round(score, 6)), "reasons": reasons})
        .filter("priority_score > 0")
        .orderBy(F.col("priority_score").desc(), F.col("cluster_size").desc(), "id").limit(limit)
    )


def compression(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("field_name").agg(
        F.count("*").alias("cluster_count"), F.coalesce(F.sum("cluster_size"), F.lit(0)).alias("label_count"),
        F.min("cluster_size").alias("min_size"), F.max("cluster_size").alias("max_size"),
        F.round(F.avg("cluster_size"), 1).alias("avg_size"),
        F.round(F.sum("cluster_size") / F.count("*"), 1).alias("compression_ratio"),
    )


def compression_totals(clusters: DataFrame, label_map: DataFrame) -> DataFrame:
    totals = clusters.agg(F.count("*").alias("total_clusters"), F.coalesce(F.sum("cluster_size"), F.lit(0)).alias("total_items"))
    raw = label_map.agg(F.countDistinct("raw_label").alias("raw_label_count"))
    return totals.join(F.broadcast(raw)).withColumn(  # two one-row tables
        "compression_ratio", F.round(F.col("raw_label_count") / F.col("total_clusters"), 1)
    )


def recovery(label_map: DataFrame, by_field: bool = True) -> DataFrame:
    """Labels whose base id differs from the final id, and those recovered by the graph.

    Base ids are stored bare and final ids with a prefix, so the first number counts nearly
    all labels; it is kept, ``graph_recovered_labels`` is what is meant.
    """
    moved = F.col("base_cluster_id").isNotNull() & (F.col("base_cluster_id") != F.col("final_cluster_id"))
    keys = ["field_name"] if by_field else []
    return label_map.groupBy(*keys).agg(
        F.count("*").alias("total_labels"), F.count_if(moved).alias("recovered_labels"),
        F.count_if(F.col("final_cluster_source") == "strict_graph_recovery").alias("graph_recovered_labels"),
    ).withColumn("rescue_rate", _rate("recovered_labels", "total_labels"))


def medoid_pool(clusters: DataFrame, names: DataFrame, pool: int | None = None) -> DataFrame:
    """Named clusters with a medoid: all, or the ``pool`` largest."""
    c = named_clusters(clusters.filter("medoid_label <> ''"), names)
    c = c if pool is None else c.orderBy(F.col("cluster_size").desc(), "id").limit(pool)
    return c.withColumn("is_weak", weak_medoid(F.col("medoid_label")))


def medoid_examples(clusters: DataFrame, names: DataFrame, n: int = 8) -> DataFrame:
    """The largest clusters with a strong and with a weak medoid."""
    w = Window.partitionBy("is_weak").orderBy(F.col("cluster_size").desc(), "id")
    return medoid_pool(clusters, names).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def medoid_by_field(clusters: DataFrame, names: DataFrame) -> DataFrame:
    return medoid_pool(clusters, names).groupBy("field_name").agg(
        F.count("*").alias("total"), F.count_if("is_weak").alias("weak")
    ).withColumn("weak_rate", _rate("weak", "total"))


def medoid_coverage(clusters: DataFrame) -> DataFrame:
    return clusters.agg(
        F.count("*").alias("total_clusters"), F.count_if(F.col("medoid_label") != "").alias("with_medoid")
    ).withColumn("coverage_rate", _rate("with_medoid", "total_clusters"))


def run_metadata(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """Runs (all, or the newest ``limit``) with the recovery numbers of their report."""

    def strict(path: str, kind: str) -> Column:
        return F.get_json_object("run_report", f"$.strict_graph_recovery.{path}").cast(kind)

    if limit is not None:
        runs = runs.orderBy(F.col("created_at").desc_nulls_last(), "field_name", "run_id").limit(limit)
    return runs.withColumns({
        "recovered_labels": strict("recovered_labels", "bigint"),
        "true_anomaly_labels": strict("true_anomaly_labels", "bigint"),
        "label_recovery_rate": strict("best_config.label_recovery_rate", "double"),
        "similarity_threshold": strict("best_config.similarity_threshold", "double"),
        "k_neighbors": strict("best_config.k_neighbors", "bigint"),
        "graph_communities_found": strict("best_config.graph_communities_found", "bigint"),
    })


def latest_metadata(wanted: DataFrame, runs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Metadata for each wanted (run_id, field_name): the newest record of run and field,
    else of the run, else of the field; numbers computed from the clusters win, blanks are
    filled from the report."""
    value = F.struct("model_name", "text_mode", "total_labels", "run_report")
    newest = F.struct(F.col("created_at"), F.col("run_id"), F.col("field_name"))

    def source(keys: list[str], tag: str) -> DataFrame:
        return runs.groupBy(*keys).agg(F.max_by(value, newest).alias(tag))

    df = (
        wanted.join(source(["run_id", "field_name"], "_a"), ["run_id", "field_name"], "left")
        .join(source(["run_id"], "_b"), "run_id", "left")
        .join(source(["field_name"], "_c"), "field_name", "left")
    )
    stats = [
        F.count("*").alias("final_cluster_count"), F.sum("cluster_size").alias("_labels"),
        F.sum("total_occurrences").alias("total_occurrences"),
        F.count_if("is_true_anomaly_cluster").alias("true_anomaly_count"),
    ]
    by_run = clusters.groupBy("run_id", "field_name").agg(*stats)
    by_field = clusters.groupBy("field_name").agg(*stats)
    names = ["final_cluster_count", "_labels", "total_occurrences", "true_anomaly_count"]
    df = df.join(by_run.select("run_id", "field_name", F.struct(*names).alias("_r")), ["run_id", "field_name"], "left")
    df = df.join(by_field.select("field_name", F.struct(*names).alias("_f")), "field_name", "left")
    m, s = F.coalesce("_a", "_b", "_c"), F.coalesce("_r", "_f")
    empty = F.lit("")
    return df.select(
        "run_id", "field_name",
        F.when(F.col("_a").isNotNull(), "exact_run_and_field").when(F.col("_b").isNotNull(), "exact_run")
        .when(F.col("_c").isNotNull(), "latest_field_metadata").otherwise("computed_from_clusters").alias("metadata_source"),
        F.coalesce(F.nullif(m["model_name"], empty), F.get_json_object(m["run_report"], "$.model_name"),
                   F.get_json_object(m["run_report"], "$.model")).alias("model_name"),
        m["text_mode"].alias("text_mode"),
        F.coalesce(s["_labels"], m["total_labels"].cast("bigint"),
                   F.get_json_object(m["run_report"], "$.total_labels").cast("bigint")).alias("total_labels"),
        s["final_cluster_count"].alias("final_cluster_count"),
        s["total_occurrences"].alias("total_occurrences"), s["true_anomaly_count"].alias("true_anomaly_count"),
    )


# -- mapper outputs -------------------------------------------------------------------------

_STATUS_COLUMNS = {
    "existing_cluster_rows": "EXISTING_CLUSTER", "new_cluster_candidate_rows": "NEW_CLUSTER_CANDIDATE",
    "true_anomaly_rows": "TRUE_ANOMALY", "no_cluster_reference_rows": "NO_CLUSTER_REFERENCE",
}


def latest_run(outputs: DataFrame) -> DataFrame:
    """One row: the run with the newest output row."""
    return (
        outputs.filter("mapper_run_id IS NOT NULL").groupBy("mapper_run_id")
        .agg(F.max("created_at").alias("_at"))
        .orderBy(F.col("_at").desc_nulls_last(), "mapper_run_id").limit(1).select("mapper_run_id")
    )


def of_run(outputs: DataFrame, run: str | None) -> DataFrame:
    """Rows of the given run, or of the latest (a join with one row)."""
    if run:
        return outputs.filter(F.col("mapper_run_id") == run)
    return outputs.join(F.broadcast(latest_run(outputs)), "mapper_run_id")


def _mapper_numbers() -> list[Column]:
    return [
        F.count("*").alias("total_rows"), F.countDistinct("source_record_id").alias("distinct_calls"),
        *[F.count_if(F.col("mapping_status") == s).alias(c) for c, s in _STATUS_COLUMNS.items()],
    ]


def mapper_summary(outputs: DataFrame, run: str | None = None) -> DataFrame:
    methods = ("exact_label_map", "centroid_similarity", "near_existing_below_threshold")
    emerging = F.col("mapping_status").isin("NEW_CLUSTER_CANDIDATE", "TRUE_ANOMALY")
    return of_run(outputs, run).groupBy("mapper_run_id").agg(
        *_mapper_numbers(),
        *[F.count_if(F.col("mapping_method") == m).alias(f"{m}_rows") for m in methods],
        F.max("classified_at").alias("latest_classified_at"),
        F.round(F.count_if(F.col("mapping_status") == "EXISTING_CLUSTER") / F.count("*"), 6).alias("existing_cluster_rate"),
        F.round(F.count_if(emerging) / F.count("*"), 6).alias("emerging_rate"),
    )


def mapper_field_health(outputs: DataFrame, run: str | None = None) -> DataFrame:
    return of_run(outputs, run).groupBy("field_name").agg(
        *_mapper_numbers(), F.round(F.avg("similarity_score"), 4).alias("avg_similarity"),
        F.round(F.count_if(F.col("mapping_status") == "EXISTING_CLUSTER") / F.count("*"), 6).alias("existing_cluster_rate"),
    )


def mapper_runs(outputs: DataFrame, limit: int = 20) -> DataFrame:
    return (
        outputs.filter("mapper_run_id IS NOT NULL").groupBy("mapper_run_id")
        .agg(*_mapper_numbers(), F.max("created_at").alias("last_written_at"))
        .orderBy(F.col("last_written_at").desc_nulls_last(), "mapper_run_id").limit(limit)
    )


def feed(outputs: DataFrame, kind: str, run: str | None = None, limit: int = 300) -> DataFrame:
    """A feed page, newest first; the canonical one shows every row as an existing cluster."""
    df = feed_views(outputs)[kind]
    if run:
        df = df.filter(F.col("mapper_run_id") == run)
    if kind == "canonical":
        df = df.withColumn("mapping_status", F.lit("EXISTING_CLUSTER"))
        order = ["source_record_id", "field_name", "raw_label"]
    elif kind == "emerging":
        order = [F.col("similarity_score").desc_nulls_last(), "source_record_id", "field_name", "raw_label"]
    else:
        order = ["source_record_id", "field_name", "raw_label"]
    return df.orderBy(F.col("classified_at").desc_nulls_last(), *order).limit(limit)


def production_overlay(outputs: DataFrame, run: str | None = None, limit: int = 1000) -> DataFrame:
    """Hits per cluster of a run, with up to six of its raw labels in order.

    Labels are distinct before they are ranked, so a hot cluster is never collected.
    """
    rows = of_run(outputs, run).filter("mapping_status = 'EXISTING_CLUSTER' AND mapped_cluster_id IS NOT NULL")
    keys = ["field_name", "mapped_cluster_id"]
    hits = rows.groupBy(*keys).agg(
        F.max("mapped_display_name").alias("mapped_display_name"), F.count("*").alias("production_hit_count"),
        F.countDistinct("source_record_id").alias("production_distinct_calls"),
        F.max("classified_at").alias("latest_classified_at"),
    )
    first = Window.partitionBy(*keys).orderBy("raw_label")
    few = (
        rows.filter("raw_label IS NOT NULL").select(*keys, "raw_label").distinct()
        .withColumn("_rn", F.row_number().over(first)).filter("_rn <= 6")
        .groupBy(*keys).agg(F.array_sort(F.collect_list("raw_label")).alias("raw_labels"))
    )
    top = hits.orderBy(F.col("production_hit_count").desc(), *keys).limit(limit)
    return top.join(few, keys, "left")


def overlay(clusters: DataFrame, hits: DataFrame, inner: bool = False) -> DataFrame:
    """Clusters with the columns of their hits; only those with a hit when ``inner``."""
    h = hits.withColumnRenamed("mapped_cluster_id", "cluster_id") if "mapped_cluster_id" in hits.columns else hits
    extra = [c for c in h.columns if c not in clusters.columns]
    return clusters.join(h.select("field_name", "cluster_id", *extra), ["field_name", "cluster_id"], "inner" if inner else "left")


def confidence_overlay(clusters: DataFrame, hits: DataFrame, limit: int = 4) -> DataFrame:
    """Best searched clusters with their confidence band."""
    df = overlay(clusters, hits, inner=True)
    return df.withColumn("confidence", bands.search_confidence(F.col("semantic_score"))).orderBy(
        F.col("semantic_score").desc(), "id"
    ).limit(limit)


# -- quality --------------------------------------------------------------------------------


def _clamp(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def cluster_quality(clusters: DataFrame, names: DataFrame, members: DataFrame) -> DataFrame:
    """Quality signals; the guessed mean similarity is kept beside the true one.

    ``members`` has field_name, cluster_id and ``embedding``.
    """
    c = named_clusters(clusters, names)
    m = members.join(
        clusters.select("field_name", "cluster_id", V.as_double(F.col("centroid_embedding")).alias("_c")),
        ["field_name", "cluster_id"],
    )
    true_mean = m.groupBy("field_name", "cluster_id").agg(
        F.round(F.avg(V.cosine(V.as_double(F.col("embedding")), F.col("_c"))), 6).alias("mean_member_cosine")
    )
    s = F.col("medoid_similarity_to_centroid")
    return c.join(true_mean, ["field_name", "cluster_id"], "left").select(
        "id", F.col("shown").isNotNull().alias("is_named"), F.col("centroid_embedding").isNotNull().alias("has_centroid"),
        (F.col("medoid_label").isNotNull() | s.isNotNull()).alias("has_medoid"), (~is_anomaly()).alias("not_anomalous"),
        F.size("centroid_embedding").alias("vector_length"),
        F.round(F.when(s.isNotNull(), _clamp(1 - (1 - s) * 1.8)), 6).alias("tightness"),
        F.round(F.when(s.isNotNull(), _clamp(s - 0.16)), 6).alias("guessed_mean_similarity"),
        "mean_member_cosine",
    )


def label_shares(label_map: DataFrame, k: int = 28) -> DataFrame:
    """First ``k`` labels of each cluster with their share of the largest count, and the sum
    shown and the number hidden."""
    keys = ["field_name", F.col("final_cluster_id").alias("cluster_id")]
    names = ["field_name", "cluster_id"]
    rows = label_map.select(*keys, "raw_label", F.coalesce("value_count", F.lit(1)).alias("value_count"))
    w = Window.partitionBy(*names).orderBy(F.col("value_count").desc(), "raw_label")
    top = rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    all_of = rows.groupBy(*names).agg(F.max("value_count").alias("_max"), F.count("*").alias("_all"))
    shown = top.groupBy(*names).agg(F.sum("value_count").alias("total_shown"), F.count("*").alias("_n"))
    return top.join(all_of, names).join(shown, names).select(
        *names, "raw_label", "value_count", "rank",
        F.round(F.col("value_count") / F.greatest(F.col("_max"), F.lit(1)), 6).alias("share"),
        "total_shown", (F.col("_all") - F.col("_n")).alias("hidden"),
    )


def field_matrix(clusters: DataFrame, names: DataFrame, label_map: DataFrame, runs: DataFrame) -> DataFrame:
    """Health of each field from all reports, with review score, status and reason."""
    comp = compression(clusters).select("field_name", F.col("label_count").alias("raw_labels"), "compression_ratio", "avg_size")
    heal = field_health(clusters, names).select(
        "field_name", F.col("total_clusters").alias("clusters"), F.col("naming_rate").alias("named_rate"),
        F.col("anomaly_rate").alias("field_anomaly_rate"), "max_cluster_size",
    )
    anom = anomaly_by_field(clusters).select("field_name", "anomaly_clusters")
    medo = medoid_by_field(clusters, names).select("field_name", F.col("weak_rate").alias("medoid_weak_rate"))
    reco = recovery(label_map).select("field_name", F.col("rescue_rate").alias("recovery_rate"), "recovered_labels")
    newest = run_metadata(runs)
    run = newest.groupBy("field_name").agg(
        F.min_by("run_id", F.struct("created_at", F.col("run_id"))).alias("run_id"),
        F.min_by("total_labels", F.struct("created_at", F.col("run_id"))).alias("run_labels"),
    )
    df = reduce(lambda a, b: a.join(b, "field_name", "full_outer"), [comp, heal, anom, medo, reco, run])
    rate = F.coalesce("field_anomaly_rate", F.lit(0.0))
    named = F.coalesce("named_rate", F.lit(1.0))
    weak = F.coalesce("medoid_weak_rate", F.lit(0.0))
    score = F.round(rate * 1.4 + F.greatest(F.lit(0.0), 1 - named) + weak * 0.7, 6)
    f = F.col("field_name")
    reason = (
        F.when(named < 1, "naming coverage incomplete")
        .when(weak > 0, "weak medoids")
        .when((f == "additional_tags") & (rate >= 0.4), "high unique-tag pressure")
        .when((f == "coaching_tags") & (rate >= 0.4), "high coaching-label variety")
        .when(rate >= 0.4, "high unresolved-label pressure")
        .when(rate >= 0.18, "monitor new variants")
        .otherwise("no cleanup signal")
    )
    return df.withColumns({
        "raw_labels": F.coalesce(F.nullif("raw_labels", F.lit(0)), F.col("run_labels").cast("bigint")),
        "anomaly_rate": rate, "review_score": score,
        "status": F.when(score > 0.45, "High").when(score > 0.18, "Monitor").otherwise("Stable"),
        "review_reason": reason,
    }).drop("run_labels", "field_anomaly_rate")


def action_items(clusters: DataFrame, names: DataFrame, outputs: DataFrame, limit: int = 6) -> DataFrame:
    """Alerts in fixed order, at most ``limit``."""
    run = of_run(outputs, None).agg(
        F.count_if(F.col("mapping_status").isin("NEW_CLUSTER_CANDIDATE", "TRUE_ANOMALY")).alias("n1"),
        F.count_if(F.col("mapping_status") == "NO_CLUSTER_REFERENCE").alias("n2"),
    )

    def item(df: DataFrame, n: int, title: Column, severity: Column, metric: Column) -> DataFrame:
        return df.select(
            F.lit(n).alias("position"), title.alias("title"), severity.alias("severity"),
            metric.cast("bigint").alias("metric"),
        )

    lit = F.lit
    missing = clusters.agg(F.count_if(F.col("centroid_embedding").isNull()).alias("n"))
    weak = medoid_pool(clusters, names).filter("is_weak").agg(F.count("*").alias("n"))
    same = same_field_duplicates(names).agg(F.count("*").alias("n"))
    worst = anomaly_by_field(clusters).orderBy(F.col("anomaly_clusters").desc(), "field_name").limit(1)
    one = clusters.limit(1)
    m = F.col("anomaly_clusters")
    items = [
        item(run.filter("n1 > 0"), 1, lit("Production emerging labels"), lit("warning"), F.col("n1")),
        item(run.filter("n2 > 0"), 2, lit("Production config issues"), lit("critical"), F.col("n2")),
        item(missing.filter("n > 0"), 3, lit("Centroid rebuild needed"), lit("critical"), F.col("n")),
        item(weak.filter("n > 0"), 4, lit("Weak medoid examples found"), lit("warning"), F.col("n")),
        item(same.filter("n > 0"), 5, lit("Same-field duplicate names"), lit("warning"), F.col("n")),
        item(worst, 6, F.concat("field_name", lit(" anomaly pressure")),
             F.when(m > 1000, "critical").otherwise("warning"), m),
        item(one, 7, lit("Drift comparison not active"), lit("info"), lit(None)),
    ]
    return reduce(DataFrame.unionByName, items).orderBy("position").limit(limit)


# -- backfill -------------------------------------------------------------------------------


def _materialized() -> Column:
    return F.coalesce(F.get_json_object("evidence_json", "$.materialized").cast("boolean"), F.lit(False))


def queue_filter(queue: DataFrame, field: str | None = None, status: str | None = None,
                 limit: int = 50, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """Page and total of the unresolved queue.

    No status: not materialized; ``null``: without status; ``MATERIALIZED``: flag true;
    other: that status and not materialized.
    """
    df = queue.filter(F.col("field_name") == field) if field else queue
    if status == "null":
        df = df.filter("resolver_status IS NULL")
    elif status == "MATERIALIZED":
        df = df.filter(_materialized())
    else:
        df = df.filter(~_materialized())
        if status:
            df = df.filter(F.col("resolver_status") == status)
    page = df.orderBy(
        F.col("occurrence_count").desc(), F.col("distinct_call_count").desc(), "field_name", "normalized_label"
    ).offset(offset).limit(limit)
    return page, df.agg(F.count("*").alias("total"))


def _newest_runs() -> list[Column]:
    return [F.col("started_at").desc_nulls_last(), F.col("backfill_run_id")]


def backfill_summary(runs: DataFrame, queue: DataFrame) -> DataFrame:
    """Progress of the newest run and the state of the queue, in one row."""
    run = runs.orderBy(*_newest_runs()).limit(1).select(
        "backfill_run_id", "status", "rows_scanned", "rows_changed",
        F.when(F.col("rows_pending") > 0, F.round(F.least(F.lit(100.0), F.col("rows_scanned") / F.col("rows_pending") * 100), 4))
        .otherwise(F.lit(0.0)).alias("progress_percent"),
        (F.unix_timestamp("finished_at") - F.unix_timestamp("started_at")).alias("duration_seconds"),
    ).withColumn(
        "rows_per_second",
        F.when(F.col("duration_seconds") > 0, F.round(F.col("rows_scanned") / F.col("duration_seconds"), 6)),
    )
    done = _materialized()
    status = F.col("resolver_status")
    counts = queue.agg(
        F.count_if(status.isNull()).alias("pending"),
        *[
            F.count_if((status == s) & ~done).alias(s.lower())
            for s in ("MAP_TO_EXISTING", "ANOMALY", "PROMOTE")
        ],
        F.count_if(done).alias("materialized"),
        F.count_if(status.isNull() | ~done).alias("total_unresolved"),
    )
    return run.join(F.broadcast(counts))  # two one-row tables


def backfill_runs(runs: DataFrame, limit: int = 20, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    return runs.orderBy(*_newest_runs()).offset(offset).limit(limit), runs.agg(F.count("*").alias("total"))


def of_backfill_run(df: DataFrame, runs: DataFrame, run: str | None) -> DataFrame:
    if run:
        return df.filter(F.col("backfill_run_id") == run)
    newest = runs.orderBy(*_newest_runs()).limit(1).select("backfill_run_id")
    return df.join(F.broadcast(newest), "backfill_run_id")  # one row


def backfill_fields(audit: DataFrame, runs: DataFrame, run: str | None = None) -> DataFrame:
    states = ("CHANGED", "UNCHANGED", "UNMAPPED", "AMBIGUOUS", "ERROR", "EMPTY")
    s = F.col("field_status")
    return of_backfill_run(audit, runs, run).groupBy("field_name").agg(
        F.count("*").alias("scanned"), *[F.count_if(s == x).alias(x.lower()) for x in states],
        F.round(100.0 * F.count_if(s == "CHANGED") / F.count("*"), 2).alias("changed_pct"),
    )


def row_audit(rows: DataFrame, audit: DataFrame, runs: DataFrame, run: str | None = None,
              status: str | None = None, field: str | None = None, limit: int = 50, offset: int = 0, after: int | None = None) -> DataFrame:
    """Audited rows of a run, newest first, with their field audits nested; ``after`` is the last id of the page before."""
    r = of_backfill_run(rows, runs, run)
    keys = ["backfill_run_id", "stage_row_id"]
    if status:
        r = r.filter(F.col("row_status") == status)
    if field:
        r = r.join(audit.filter(F.col("field_name") == field).select(*keys), keys, "left_semi")
    order = [("id", True)]
    rows = page(r, order, limit + offset, None if after is None else {"id": after})
    top = rows.orderBy(F.col("id").desc()).offset(offset).limit(limit) if offset else rows
    entry = F.struct("field_name", "old_value", "new_value", "field_status")
    nested = audit.join(top.select(*keys), keys, "left_semi").groupBy(*keys).agg(
        F.array_sort(F.collect_list(entry)).alias("field_audit")
    )
    return top.join(nested, keys, "left")
