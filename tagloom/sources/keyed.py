"""A Parquet table kept by key, of which a change reads and writes only the touched buckets."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StructType

from ..lineage import cut
from .io import latest_per_key, update_or_insert, upsert

BUCKET = "_bucket"
#: Files that a task writes at once; the rows of further buckets are sorted by bucket first.
OPEN_FILES = 8


@contextmanager
def _open_files(spark: SparkSession):
    """Tasks with few buckets write their rows as they come, without a sort of wide rows."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _nullable(kind: DataType) -> DataType:
    """The type with nulls allowed everywhere, as a reader of Parquet has it."""
    return StructType.fromJson(json.loads(kind.json().replace('"nullable":false', '"nullable":true').replace(
        '"containsNull":false', '"containsNull":true').replace('"valueContainsNull":false', '"valueContainsNull":true')))


class KeyedTable:
    """Rows in folders by bucket, the hash of ``by`` (the keys unless given), replaced bucket by bucket.

    ``by`` are columns that a key's row never changes and that say which rows a change touches: the keys for upserts, the
    label for outputs that are rewritten a label at a time. A change of few keys touches at most as many buckets.

    A change is first written whole beside the table, for its touched buckets, and then its folders take the place of the old
    ones, by a rename each, which the file system must do as a whole. A driver lost before the first step ends leaves the old
    state; one lost later leaves the new one: readers take the buckets that are still in the written change from there, and the
    next change moves them in first. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), buckets: int = 64, by: Sequence[str] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.rows_path, self._layout_path = f"{self.path}/rows", f"{self.path}/layout"
        if self._complete(self._layout_path):
            kept = self.spark.read.json(self._layout_path).first()
            self.keys, self.by, self.buckets = list(kept["keys"]), list(kept["by"]), kept["buckets"]
            self.schema = StructType.fromJson(json.loads(kept["table"]))
        else:
            self.keys, self.by, self.buckets, self.schema = list(keys), list(by or keys), buckets, None

    # -- files

    def _fs(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _complete(self, path: str) -> bool:
        fs, where = self._fs(f"{path}/_SUCCESS")
        return fs.exists(where)

    def _delete(self, path: str) -> None:
        for p in (f"{path}/_SUCCESS", path):  # without its marker the folder is nothing any more
            fs, where = self._fs(p)
            fs.delete(where, True)

    def _changes(self) -> list[str]:
        fs, root = self._fs(self.path)
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return [f"{self.path}/{n}" for n in names if n.startswith("change-")]

    def _pending(self) -> str | None:
        """A change that was written but not known to be moved in; there is one at most."""
        return next(filter(self._complete, self._changes()), None)

    def _buckets_in(self, path: str) -> list[int]:
        fs, where = self._fs(path)
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))

    # -- rows

    def exists(self) -> bool:
        return self.schema is not None

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _stored(self, path: str) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema.fields]).add(BUCKET, IntegerType())).parquet(path)

    def _rows(self, buckets: list[int] | None = None) -> DataFrame:
        """Rows of the buckets (all unless given) with their bucket; other folders are not listed for reading."""
        parts, later = [], self._pending()
        newer = self._buckets_in(later) if later else []
        if self._buckets_in(self.rows_path):
            rows = self._stored(self.rows_path)
            parts.append(rows.filter(~F.col(BUCKET).isin(newer)) if newer else rows)
        if newer:
            parts.append(self._stored(later))
        if not parts:
            return self.spark.createDataFrame([], StructType([*self.schema.fields]).add(BUCKET, IntegerType()))
        found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return found if buckets is None else found.filter(F.col(BUCKET).isin(buckets))

    def read(self) -> DataFrame:
        return self._rows().drop(BUCKET)

    def _as_stored(self, df: DataFrame) -> DataFrame:
        """Columns cast to the table's types, as equal values of other types have other hashes."""
        kinds = {f.name: f.dataType for f in self.schema.fields}
        now = {f.name: f.dataType for f in df.schema.fields}
        other = {c for c in df.columns if c in kinds and kinds[c].simpleString() != now[c].simpleString()}
        return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in other else F.col(c) for c in df.columns])

    def touched(self, changes: DataFrame) -> DataFrame:
        """Rows of the buckets that the rows of ``changes`` fall into, no others being read."""
        return self._rows(self._touched(self._as_stored(changes))).drop(BUCKET)

    def _touched(self, changes: DataFrame) -> list[int]:
        return [r[0] for r in changes.select(self.bucket().alias("b")).distinct().collect()]  # at most ``buckets`` numbers

    # -- changes

    def create(self, df: DataFrame, dealt: bool = False) -> None:
        """The table's columns and first rows; keys are not checked. ``dealt``: rows of a bucket lie together already."""
        if self.exists():
            raise ValueError(f"there is a table in {self.path}")
        self.schema = _nullable(df.schema)
        layout = [(self.keys, self.by, self.buckets, df.schema.json())]
        kinds = "keys array<string>, by array<string>, buckets int, table string"
        self.spark.createDataFrame(layout, kinds).coalesce(1).write.mode("overwrite").json(self._layout_path)
        self._write(df, dealt)

    def _write(self, df: DataFrame, dealt: bool = False) -> None:
        """Write the new rows of whole buckets beside the table, then move them in."""
        self.recover()
        path = f"{self.path}/change-{uuid.uuid4().hex}"
        columns = [f.name for f in self.schema.fields]
        rows = self._as_stored(df).select(*columns).withColumn(BUCKET, self.bucket())
        with _open_files(self.spark):
            (rows if dealt else rows.repartition(BUCKET)).write.partitionBy(BUCKET).parquet(path)
        self._move_in(path)

    def _move_in(self, path: str) -> None:
        fs, root = self._fs(self.rows_path)
        fs.mkdirs(root)
        for bucket in self._buckets_in(path):
            new, old = (self._fs(f"{x}/{BUCKET}={bucket}")[1] for x in (path, self.rows_path))
            fs.delete(old, True)
            if not fs.rename(new, old):
                raise OSError(f"cannot move {new.toString()} to {old.toString()}")
        self._delete(path)

    def recover(self) -> None:
        """Move in what a lost driver left written; harmless if there is nothing."""
        if self.exists() and (path := self._pending()):
            self._move_in(path)
        for path in self._changes():  # never finished
            self._delete(path)

    def update(self, touching: DataFrame, change: Callable[[DataFrame], DataFrame]) -> None:
        """Replace the rows of the buckets that ``touching`` (rows with the columns ``by``) falls into by ``change(rows)``.

        ``change`` keeps every bucket's rows in it, and at least one: it may update and add, not empty a bucket.
        """
        self.recover()
        buckets = self._touched(self._as_stored(touching))
        if buckets:
            self._write(change(self._rows(buckets).drop(BUCKET)))

    def upsert(self, source: DataFrame, rules: dict[str, str] | None = None, newest_first: list[Column] | None = None,
               dealt: bool = False) -> None:
        """Insert or update by key, as ``io.upsert`` does. ``dealt``: rows of a bucket lie together already."""
        if not self.exists():
            self.create(latest_per_key(source, self.keys, newest_first) if newest_first else source, dealt and not newest_first)
            return
        source = cut(self._as_stored(source))
        self.update(source, lambda rows: upsert(rows, source, self.keys, rules, newest_first))

    def update_or_insert(self, source: DataFrame, keep: tuple[str, ...] = ("created_at",)) -> None:
        """Update all rows of a key, insert the source row where there is none, as ``io.update_or_insert`` does."""
        if not self.exists():
            self.create(source)
            return
        source = cut(self._as_stored(source))
        self.update(source, lambda rows: update_or_insert(rows, source, self.keys, keep))
