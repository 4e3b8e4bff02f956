"""Readers and writers: label input, call windows, history, state tables, exports."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_label, strip, valid_label
from ..lineage import cut

# -- label input ------------------------------------------------------------------------


def read_label_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; all columns as text, see :func:`prepare_labels`."""
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')


def read_label_sql(
    spark: SparkSession, query: str | None = None, jdbc: dict | None = None, **tables: DataFrame
) -> DataFrame:
    """Rows of a query that returns source_column, raw_value and value_count."""
    df = spark.sql(query, **tables) if query else spark.read.format("jdbc").options(**jdbc).load()
    lacking = {"source_column", "raw_value", "value_count"} - set(df.columns)
    if lacking:
        raise ValueError(f"query result lacks columns {sorted(lacking)}")
    return df.select("source_column", "raw_value", "value_count")


def dense_index(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Dense number from 0 in the total order of ``order``, without a single sorting task.

    Rows are range-partitioned and sorted; each partition's offset is the size of those
    before it. The sorted rows are checkpointed, so a lost task cannot renumber them.
    """
    placed = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    # One row per partition: bounded by the number of shuffle partitions.
    sizes = placed.groupBy("_part").count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + F.col("_pos")).cast("bigint"))
        .drop("_part", "_pos", "_offset")
    )


def prepare_labels(df: DataFrame) -> DataFrame:
    """Clean label rows with a dense id in (source_column, raw_value) order."""
    lacking = {"source_column", "raw_value"} - set(df.columns)
    if lacking:
        raise ValueError(f"label input lacks columns {sorted(lacking)}")
    raw = F.col("raw_value").cast("string")
    count = F.col("value_count").cast("string") if "value_count" in df.columns else F.lit("1")
    norm = (
        F.coalesce(F.col("normalized_value"), normalize_label(raw))
        if "normalized_value" in df.columns
        else normalize_label(raw)
    )
    clean = df.select(
        F.coalesce(F.col("source_column").cast("string"), F.lit("unknown")).alias("source_column"),
        F.coalesce(raw, F.lit("")).alias("raw_value"),
        F.coalesce(F.floor(count.try_cast("double")).cast("bigint"), F.lit(1)).alias("value_count"),
        norm.alias("normalized_value"),
    ).filter(strip(F.col("raw_value")) != "")
    order = ["source_column", "raw_value", "value_count", "normalized_value"]
    return dense_index(clean, order, "global_label_id")


# -- call rows --------------------------------------------------------------------------


def compute_window(
    start: str | datetime | None,
    end: str | datetime | None,
    lookback: timedelta,
    reject_empty: bool = True,
) -> tuple[datetime, datetime]:
    """Half-open UTC window; the end defaults to now, the start to end - lookback."""

    def utc(value):
        if isinstance(value, str):
            value = datetime.fromisoformat(value.strip().replace("Z", "+00:00"))
        return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(
            timezone.utc
        )

    stop = utc(end) if end else datetime.now(timezone.utc)
    begin = utc(start) if start else stop - lookback
    if reject_empty and begin >= stop:
        raise ValueError(f"window start {begin} is not before its end {stop}")
    return begin, stop


def window_rows(
    df: DataFrame,
    ts: str | Column | list[str],
    start: str | datetime | None = None,
    end: str | datetime | None = None,
    lookback: timedelta = timedelta(hours=1),
    reject_empty: bool = True,
) -> DataFrame:
    """Rows with ``start <= ts < end``; a plain filter, so it reaches the scan.

    Of a list of columns the first that is not null counts: an OR of comparisons, which a reader of Parquet can use where
    it cannot use a coalesce.
    """
    begin, stop = compute_window(start, end, lookback, reject_empty)

    def inside(col: Column) -> Column:
        return (col >= F.lit(begin)) & (col < F.lit(stop))

    if not isinstance(ts, list):
        return df.filter(inside(F.col(ts) if isinstance(ts, str) else ts))
    hit = F.lit(False)
    for i in reversed(range(len(ts))):
        hit = inside(F.col(ts[i])) | (F.col(ts[i]).isNull() & hit) if i < len(ts) - 1 else inside(F.col(ts[i]))
    return df.filter(hit)


def read_call_window(
    df: DataFrame,
    columns: list[str],
    ts: str | None,
    start=None,
    end=None,
    where: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Listed columns (each once, in order) of the window, by time; optional predicate."""
    if ts:
        df = window_rows(df, ts, start, end)
    if where:
        df = df.filter(where)
    wanted = list(dict.fromkeys([*columns, *([ts] if ts else [])]))
    df = df.select(*wanted)
    if ts:
        df = df.orderBy(ts)
    return df.limit(limit) if limit else df


def id_ranges(low: int, high: int, n: int) -> list[tuple[int, int]]:
    """At most ``n`` inclusive ranges of equal width that cover low..high."""
    step = max(1, -(-(high - low + 1) // max(1, n)))
    return [(a, min(high, a + step - 1)) for a in range(low, high + 1, step)]


def read_by_id_ranges(
    spark: SparkSession, jdbc: dict, id_column: str, low: int, high: int, n: int
) -> DataFrame:
    """JDBC table read in ``n`` id ranges, one per task (parquet splits by itself)."""
    return spark.read.format("jdbc").options(
        **jdbc, partitionColumn=id_column, lowerBound=low, upperBound=high + 1, numPartitions=n
    ).load()


def range_counts(df: DataFrame, id_column: str, n: int) -> DataFrame:
    """Rows, least and greatest id of each of ``n`` equal id ranges of the table."""
    span = df.agg(F.min(id_column).alias("lo"), F.max(id_column).alias("hi"))
    step = F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / F.lit(n)))
    return (
        df.select(id_column)
        .join(F.broadcast(span))  # one row
        .groupBy(F.floor((F.col(id_column) - F.col("lo")) / step).cast("bigint").alias("range_no"))
        .agg(
            F.count("*").alias("n_rows"),
            F.min(id_column).alias("first_id"),
            F.max(id_column).alias("last_id"),
        )
    )


def read_history_counts(df: DataFrame, norm_variant: str = "loose") -> DataFrame:
    """Historical unresolved counts per field and label, under any accepted header."""
    names = {c.lstrip("\ufeff"): c for c in df.columns}

    def first_of(*options: str) -> Column:
        cols = [F.nullif(F.col(f"`{names[o]}`").cast("string"), F.lit("")) for o in options if o in names]
        return F.coalesce(*cols) if cols else F.lit(None).cast("string")

    field = strip(F.coalesce(first_of("field_name", "field"), F.lit("")))
    raw = strip(
        F.coalesce(
            first_of("label", "raw_label", "normalized_label", "unmapped_label"), F.lit("")
        )
    )
    given = F.coalesce(first_of("count", "occurrence_count", "occurrences"), F.lit("1"))
    number = strip(given).try_cast("double")
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("bigint")
    return (
        df.select(
            field.alias("field_name"),
            normalize_label(raw, norm_variant).alias("normalized_label"),
            F.coalesce(whole, F.lit(1)).alias("n"),
        )
        .filter((F.col("field_name") != "") & F.col("normalized_label").isNotNull())
        .filter(F.col("n") > 0)
        .groupBy("field_name", "normalized_label")
        .agg(F.sum("n").cast("bigint").alias("historical_count"))
    )


# -- state ------------------------------------------------------------------------------


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """One row per key; rows that tie in ``newest_first`` are equal for the caller."""
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    rules: dict[str, str] | None = None,
    newest_first: list[Column] | None = None,
) -> DataFrame:
    """Insert or update by key.

    Rules per column when both sides have the row: ``replace`` (default), ``keep``,
    ``greatest``, ``now`` (update time). The source is reduced to one row per key first. Null keys are equal to
    each other, as any other value.
    """
    rules = rules or {}
    if newest_first:
        source = latest_per_key(source, keys, newest_first)
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    both = t.join(s, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys], "full_outer")
    has_s, has_t = F.col("s._in_s").isNotNull(), F.col("t._in_t").isNotNull()
    out = []
    for c in target.columns:
        old = F.col(f"t.{c}")
        new = F.col(f"s.{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        rule = rules.get(c, "replace" if c in source.columns else "keep")
        if c in keys:
            value = F.when(has_t, old).otherwise(new)
        elif rule == "keep":
            value = F.when(has_t, old).otherwise(new)
        elif rule == "greatest":
            value = F.greatest(old, new)
        elif rule == "now":
            value = F.when(has_s, F.current_timestamp()).otherwise(old)
        else:
            value = F.when(has_s, new).otherwise(old)
        out.append(value.alias(c))
    return both.select(*out)


def update_or_insert(
    target: DataFrame, source: DataFrame, keys: list[str], keep: tuple[str, ...] = ("created_at",)
) -> DataFrame:
    """Update every target row of a key, insert the source row when no row has the key."""
    t, s = target.alias("t"), source.alias("s")
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    marked = t.join(s.withColumn("_hit", F.lit(True)).alias("s"), same, "left")
    updated = marked.select(
        *[
            (
                F.col(f"t.{c}")
                if c in keys or c in keep or c not in source.columns
                else F.when(F.col("s._hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
            ).alias(c)
            for c in target.columns
        ]
    )
    inserted = s.join(t, same, "left_anti")
    return updated.unionByName(
        inserted.select(*[c for c in source.columns if c in target.columns]),
        allowMissingColumns=True,
    )


def label_map_rows(mapping: DataFrame, run_id: str, version: str) -> DataFrame:
    """Rows to append to the label map: usable labels only, ids as text."""
    ids = ["base_cluster_id", "strict_graph_community_id", "final_cluster_id"]
    df = mapping.filter(valid_label(F.col("raw_label")))
    return df.withColumns(
        {c: F.col(c).cast("string") for c in ids if c in df.columns}
        | {"run_id": F.lit(run_id), "cluster_version": F.lit(version)}
    )


def append_label_map(mapping: DataFrame, path: str, run_id: str, version: str) -> None:
    label_map_rows(mapping, run_id, version).write.mode("append").parquet(path)


def deactivate(clusters: DataFrame, fields: list[str]) -> DataFrame:
    """Active rows of the fields become inactive."""
    hit = F.col("field_name").isin(fields) & F.coalesce(F.col("active"), F.lit(True))
    return clusters.withColumn("active", F.when(hit, F.lit(False)).otherwise(F.col("active")))


def run_row(spark: SparkSession, **values) -> DataFrame:
    """One run record (status, counts, window, configuration JSON, error)."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


# -- output -----------------------------------------------------------------------------


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a preview, review or report table; nested columns as JSON for CSV."""
    if fmt == "csv":
        flat = [
            F.to_json(f.name).alias(f.name)
            if f.dataType.typeName() in ("array", "struct", "map")
            else F.col(f.name)
            for f in df.schema.fields
        ]
        df.select(*flat).write.mode("overwrite").csv(path, header=True)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def report_rows(one_row: DataFrame) -> DataFrame:
    """(metric, value) rows of a one-row report."""
    texts = [F.col(c).cast("string").alias(c) for c in one_row.columns]
    return one_row.select(*texts).unpivot([], one_row.columns, "metric", "value")


def feed_views(outputs: DataFrame) -> dict[str, DataFrame]:
    """Canonical, emerging and configuration-issue feeds of the mapper outputs."""
    ids = [
        "source_db", "source_table", "source_record_id", "source_created_at", "classified_at",
        "source_metadata", "field_name", "raw_label", "normalized_label",
    ]
    times = ["mapper_run_id", "created_at", "updated_at"]
    feeds = {
        "canonical": (
            ["EXISTING_CLUSTER", "KNOWN_TRUE_ANOMALY"],
            ["mapped_cluster_id", "mapped_display_name", "similarity_score", "cluster_version",
             "mapping_method"],
        ),
        "emerging": (
            ["NEW_CLUSTER_CANDIDATE", "TRUE_ANOMALY"],
            ["similarity_score", "existing_cluster_threshold", "new_cluster_candidate_threshold",
             "mapping_status", "top_candidates", "cluster_version"],
        ),
        "config_issue": (["NO_CLUSTER_REFERENCE"], ["mapping_status"]),
    }
    return {
        name: outputs.filter(F.col("mapping_status").isin(statuses)).select(
            *[c for c in ids + own + times if c in outputs.columns]
        )
        for name, (statuses, own) in feeds.items()
    }


