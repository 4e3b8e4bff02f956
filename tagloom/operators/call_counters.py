"""Distinct-call counters that add up: bitmaps of dense call numbers, stored a batch and day at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lineage import cut
from ..sources.io import dense_index
from ..sources.keyed import KeyedTable
from .weekly import GROUP, cluster_labels, event_time


class CallCounters:
    """Rows, calls and weeks of every label, kept up batch by batch and merged for any set of labels.

    Calls are numbered densely as they first come, so that a bitmap of 32,768 numbers stands for the calls of a label and
    day among them; bitmaps of more days, labels or batches are merged by OR, which counts no call twice. A batch reads its
    own rows, the buckets of the call numbers that its calls fall into, and nothing of the history. Adding a batch
    again, as after a lost driver, replaces it.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.numbers = KeyedTable(spark, f"{self.path}/numbers", ["source_record_id"], buckets)
        self._made = f"{self.path}/made"

    def _number(self, rows: DataFrame) -> DataFrame:
        """(source_record_id, call_no) of the rows' calls; new calls get the next numbers, from 1."""
        ids = cut(rows.filter("source_record_id IS NOT NULL").select("source_record_id").distinct())
        if not self.numbers.exists():
            self.numbers.create(self.spark.createDataFrame([], "source_record_id string, call_no long"))
        known = cut(self.numbers.touched(ids).join(ids, "source_record_id", "left_semi"))
        fresh = ids.join(known, "source_record_id", "left_anti")
        # How far numbers go is written before they are given out: a lost driver leaves a gap, never a number twice.
        fs, where = self.numbers._fs(self._made)
        upto = self.spark.read.parquet(self._made).agg(F.max("upto")).first()[0] if fs.exists(where) else 0
        numbered = cut(dense_index(fresh, ["source_record_id"], "_n").select(
            "source_record_id", (F.col("_n") + upto + 1).cast("long").alias("call_no")))
        n = numbered.count()
        if n:
            self.spark.range(1).select(F.lit(upto + n).cast("long").alias("upto")).write.mode("append").parquet(self._made)
            self.numbers.upsert(numbered)
        return known.unionByName(numbered)

    def add(self, outputs: DataFrame, batch: str) -> None:
        """Add the rows of one batch; a batch of the same name is replaced."""
        t = event_time()
        rows = cut(outputs.select(*GROUP, F.col("source_record_id").cast("string").alias("source_record_id"), t.alias("at"),
                                  F.to_date(t).alias("day"), F.date_trunc("week", t).alias("week")))
        days = rows.groupBy(*GROUP, "day", "week").agg(F.count("*").alias("n"), F.min("at").alias("first_seen"), F.max("at").alias("last_seen"))
        calls = rows.join(self._number(rows), "source_record_id").select(*GROUP, "day", "call_no").distinct()
        bits = calls.groupBy(*GROUP, "day", F.bitmap_bucket_number("call_no").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("call_no")).alias("bitmap"))
        for name, part in (("days", days), ("bitmaps", bits)):
            part.withColumn("batch", F.lit(batch)).write.partitionBy("batch").option(
                "partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{self.path}/{name}")

    def stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def cluster_counters(self, label_map: DataFrame) -> DataFrame:
        """The same columns and values as ``weekly.cluster_counters``, from the stored rows alone."""
        labels = cut(cluster_labels(label_map))
        key = ["field_name", "cluster_id"]
        merged = self.stored("bitmaps").join(labels.select(*GROUP, "cluster_id"), GROUP).groupBy(*key, "bucket").agg(
            F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("calls"))
        calls = merged.groupBy(*key).agg(F.sum("calls").alias("distinct_call_count"))
        numbers = self.stored("days").join(labels, GROUP).groupBy(*key).agg(
            F.sum("n").alias("row_count"), F.countDistinct("week").alias("weeks_seen"), F.max("label_sum").alias("label_occurrence_sum"),
            F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
        return numbers.join(calls, key, "left").select(
            *key, "row_count", F.coalesce("distinct_call_count", F.lit(0)).alias("distinct_call_count"), "weeks_seen",
            "label_occurrence_sum", "first_seen", "last_seen")
