"""Stable keys and times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from .text import safe_part, strip


def _joined(sep: str, *cols: Column) -> Column:
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def dedupe_key(db, table, record, field, norm, version) -> Column:
    return F.sha2(_joined("|", db, table, record, field, norm, version), 256)


def old_dedupe_key(db, table, record, field, norm, version) -> Column:
    """Key of rows written before the long hash."""
    return F.md5(_joined("|", db, table, record, field, norm, version))


def stable_hash(*parts: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(_joined("||", *parts), 256), 1, length)


def cluster_id_for(prefix: str, field: Column, norm: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), stable_hash(field, norm, length=18))


def record_id(given: Column | None, columns: list[str]) -> Column:
    """Given id, else a hash of the row's JSON with columns in name order."""
    payload = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]))
    made = F.concat(F.lit("generated_"), F.substring(F.sha2(payload, 256), 1, 24))
    return made if given is None else F.coalesce(given.cast("string"), made)


def cache_key(fields: Column, model: str, mode: str, name: str | None = None) -> Column:
    """Key of an embedding cache from the array of field names."""
    if name:
        return safe_part(F.lit(name))
    joined = F.array_join(F.array_sort(F.array_distinct(fields)), "_")
    safe_model = safe_part(F.lit(model.replace("/", "_")))
    return F.concat_ws("_", safe_part(joined), safe_model, F.lit(mode))


def _marks(c: Column, kind: DataType) -> Column:
    """Where a value is null and how long its arrays are, which hashes pass over."""
    if isinstance(kind, ArrayType):
        return F.struct(c.isNull(), F.size(c), F.transform(c, lambda x: _marks(x, kind.elementType)))
    if isinstance(kind, StructType):
        return F.struct(c.isNull(), *[_marks(c[f.name], f.dataType) for f in kind.fields])
    return c.isNull()


def row_hashes(df: DataFrame, key: str) -> DataFrame:
    """``h1``, a 64-bit hash of the key, and ``h2``, one of all columns in name order: only equal rows share both."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    parts = [x for f in fields for x in (_marks(F.col(f.name), f.dataType), F.col(f.name))]
    return df.select(F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(*parts).alias("h2"))


def to_utc(c: Column) -> Column:
    """Text or naive time to a UTC timestamp; unreadable text is null.

    The session time zone is UTC, so a text without a zone is read as UTC.
    """
    text = strip(c.cast("string"))
    return F.when(
        ~F.lower(text).isin("", "nan", "none", "null"), F.try_to_timestamp(text)
    )
