"""Approximate distinct calls for reports: sketches by hour, merged for any window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.io import window_rows

#: Binary logarithm of a sketch's registers; the relative standard error is about 1.04 / sqrt(2 ** LG), 1.6 percent.
LG = 12


def hourly_sketches(outputs: DataFrame, by: list[str], ts: str = "classified_at", lg: int = LG) -> DataFrame:
    """(hour, by, n_rows, calls): rows and the sketch of their call ids, a row an hour; small enough to keep and to add to."""
    return outputs.groupBy(F.date_trunc("hour", ts).alias("hour"), *by).agg(
        F.count("*").alias("n_rows"), F.hll_sketch_agg(F.coalesce(F.col("source_record_id").cast("string"), F.lit("")), F.lit(lg)).alias("calls"),
        F.count_if(F.col("source_record_id").isNull()).alias("n_null"))


def approximate_counts(sketches: DataFrame, by: list[str], start=None, end=None) -> DataFrame:
    """(by, n_rows, distinct_calls) of the hours in the window (all without one), from the sketches alone."""
    rows = window_rows(sketches, "hour", start, end) if start or end else sketches
    merged = rows.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("calls")).alias("_calls"), F.sum("n_null").alias("_null"))
    return merged.select(*by, "n_rows", (F.col("_calls") - F.when(F.col("_null") > 0, 1).otherwise(0)).alias("distinct_calls"))
