"""Helpers that several operators share."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a side that may be broadcast after they were counted; beyond it the plain join runs.
BROADCAST_ROWS = 1_000_000
#: Bytes of text that a Python task works on at a time.
SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch: documents are long, and a batch is held twice on its way to Python.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to BATCH_ROWS rows; for whole jobs (queries, the pipeline), not for operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_of(df: DataFrame, text: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(df[text].cast("string"), F.lit(""))


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table with a broadcast hint if it was counted and has at most ``rows`` rows of few narrow columns."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def buckets_for(rows: int) -> int:
    """About the square root of the rows per bucket, so that neither a bucket nor the table of buckets grows large."""
    return max(1, math.ceil(rows / max(256, math.isqrt(rows))))


def number_rows(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), rows: int | None = None,
                name: str = "row_no") -> DataFrame:
    """Add ``name``: gapless numbers from 0 (for each value of ``within``), the same on every run.

    Rows are dealt to hash buckets, a bucket is sorted by ``order``, and the buckets' counts give the number each
    starts from: nothing is sorted as a whole, and no task has more than a bucket, however hot a value of ``within``
    is. Rows equal in ``order`` are interchangeable. Columns of ``within`` hold no null.
    """
    n = buckets_for(df.count() if rows is None else rows)
    at = [*within, "_bucket"]
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    counts = dealt.groupBy(*at).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    before = before.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*at, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*at).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    out = dealt.join(starts, at)
    return out.withColumn(name, F.col("_start") + F.row_number().over(inside) - 1).drop("_bucket", "_start")


def slices(batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text, at least a row each."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)
