"""From wide rows to long label rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import record_id, to_utc
from ..functions.lists import MULTI_FIELDS
from ..functions.text import (
    distinct_labels, normalize_label, parse_stage_labels, parse_stage_text, pin, split_label_items, strip,
)
from ..functions.vectors import _finite



def long_cells(df: DataFrame, keep: list[Column], fields: list[str], deal: str | None = None) -> DataFrame:
    """Kept columns, ``field_name`` and the cell as text or array: one narrow pass.

    Later rules then exist once per cell and not once per field. With ``deal``, a kept column, the rows are dealt out by
    it before their cells are, so that the rules run in all tasks however few parts the input has.
    """
    structs = []
    for f in (f for f in fields if f in df.columns):
        is_array = df.schema[f].dataType.typeName() == "array"
        structs.append(
            F.struct(
                F.lit(f).alias("field_name"),
                (F.lit(None) if is_array else F.col(f)).cast("string").alias("_cell"),
                (F.col(f) if is_array else F.lit(None)).cast("array<string>").alias("_array"),
            )
        )
    if deal is None:
        return df.select(*keep, F.inline(F.array(*structs)))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = df.select(*keep, F.array(*structs).alias("_cells"))
    return wide.repartition(parts, deal).select(*wide.columns[:-1], F.inline("_cells"))


def explode_positions(df: DataFrame, keep: list, array: Column, pos: str, item: str) -> DataFrame:
    """``posexplode`` that computes the array once.

    The plain form infers a ``size(array) > 0`` filter that repeats the array's whole
    expression below the projection; the outer form with a null test does not.
    """
    return df.select(*keep, F.posexplode_outer(array).alias(pos, item)).filter(
        F.col(pos).isNotNull()
    )


def _with_labels(long: DataFrame) -> DataFrame:
    """Replace the cell by ``labels``: array of struct(_items, _norms) by the mapper rule."""
    cell, arr = F.col("_cell"), F.col("_array")
    items = F.when(arr.isNotNull(), split_label_items(arr, True)).otherwise(
        split_label_items(cell)
    )
    df = pin(long, {"_items": items})
    df = pin(df, {"_norms": F.transform("_items", lambda x: normalize_label(x, "mapper"))})
    labels = distinct_labels(F.arrays_zip("_items", "_norms"), F.col("_norms"))
    return df.withColumn("labels", labels).drop("_cell", "_array", "_items", "_norms")


def label_rows(long: DataFrame, keep: list[str], rule: str) -> DataFrame:
    """One row per label of ``long_cells`` rows, with its position in the cell."""
    if rule == "mapper":
        rows = explode_positions(
            _with_labels(long), [*keep, "field_name"], F.col("labels"), "pos", "_l"
        )
        return rows.select(
            *keep, "field_name", "pos",
            F.col("_l._items").alias("raw_label"), F.col("_l._norms").alias("normalized_label"),
        )
    long = pin(long, {"_text": strip(F.col("_cell"))})
    arr, multi = F.col("_array"), F.col("field_name").isin(MULTI_FIELDS)
    labels = F.when(arr.isNotNull(), parse_stage_labels(arr, True, True)).otherwise(
        parse_stage_text(F.col("_text"), multi)
    )
    rows = explode_positions(long, [*keep, "field_name"], labels, "pos", "raw_label")
    return rows.withColumn("normalized_label", normalize_label(F.col("raw_label"), "loose"))


def cells_to_labels(
    df: DataFrame, fields: list[str], keep: list[str], rule: str = "mapper"
) -> DataFrame:
    """One row per label of each cell, with its position in the cell."""
    return label_rows(long_cells(df, [F.col(k) for k in keep], fields), keep, rule)


def counted_cells(df: DataFrame, fields: list[str]) -> DataFrame:
    """Distinct cells with the number of rows that have them; cells are counted on the way, so only distinct ones move."""
    long = long_cells(df, [], fields).filter("_cell IS NOT NULL OR _array IS NOT NULL")
    return long.groupBy("field_name", "_cell", "_array").agg(F.count("*").alias("_rows"))


def label_facts(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field_name, raw_label, value_count): cells are counted first, and each distinct cell is parsed once."""
    return (
        label_rows(counted_cells(df, fields), ["_rows"], "mapper")
        .groupBy("field_name", "raw_label")
        .agg(F.sum("_rows").alias("value_count"))
    )


def source_metadata(df: DataFrame, columns: list[str]) -> Column:
    """JSON of the listed columns that exist; times as ISO text, NaN as null."""
    values = []
    for c in (c for c in columns if c in df.columns):
        kind = df.schema[c].dataType.typeName()
        col = F.col(c)
        if kind in ("double", "float"):
            col = F.when(_finite(col), col)
        elif kind in ("timestamp", "timestamp_ntz", "date"):
            col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        values.append(col.alias(c))
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"})


def explode_calls(
    df: DataFrame,
    fields: list[str],
    source_db: str,
    source_table: str,
    id_column: str | None = None,
    created: str = "created_at",
    classified: str | None = None,
    metadata: list[str] | None = None,
    unique_ids: bool = False,
) -> DataFrame:
    """Call rows to distinct (record, field, normalized label) rows.

    Of several rows of one record the earliest wins, then the position in the cell. With
    ``unique_ids`` the cell-level removal of repeats is enough. Rows are dealt out by record
    while they are narrow, and that is the one shuffle: labels of a record stay together.
    """
    given = F.col(id_column) if id_column else None
    at = to_utc(F.col(created))
    keep = [
        record_id(given, df.columns).alias("source_record_id"),
        at.alias("source_created_at"),
        (F.coalesce(to_utc(F.col(classified)), at) if classified else at).alias("classified_at"),
        source_metadata(df, metadata or []).alias("source_metadata")
        if metadata
        else F.lit(None).cast("string").alias("source_metadata"),
    ]
    long = long_cells(df, keep, fields, "source_record_id")
    if not unique_ids:  # equal cells of a record have equal labels: each is parsed once, as its earliest row has it
        at = F.min(F.struct("source_created_at", "classified_at", "source_metadata"))
        long = long.groupBy("source_record_id", "field_name", "_cell", "_array").agg(at.alias("at")).select(
            "source_record_id", "at.*", "field_name", "_cell", "_array")
    rows = explode_positions(
        _with_labels(long),
        ["source_record_id", "source_created_at", "classified_at", "source_metadata", "field_name"],
        F.col("labels"), "pos", "_l",
    )
    rows = rows.withColumns(
        {"raw_label": F.col("_l._items"), "normalized_label": F.col("_l._norms")}
    ).drop("_l")
    if not unique_ids:
        first = F.struct("source_created_at", "pos", "raw_label", "classified_at", "source_metadata")
        rows = (
            rows.groupBy("source_record_id", "field_name", "normalized_label")
            .agg(F.min(first).alias("r"))
            .select("source_record_id", "field_name", "normalized_label", "r.*")
        )
    return rows.drop("pos").withColumns(
        {"source_db": F.lit(source_db), "source_table": F.lit(source_table)}
    )


def discover_labels(stage: DataFrame, fields: list[str]) -> DataFrame:
    """Count of each (field, raw, loose-normal) label over all stage rows; each distinct cell is parsed once."""
    return (
        label_rows(counted_cells(stage, fields), ["_rows"], "stage")
        .filter(F.col("normalized_label").isNotNull())
        .groupBy("field_name", "raw_label", "normalized_label")
        .agg(F.sum("_rows").alias("label_count"))
    )
