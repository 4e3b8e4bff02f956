"""Centroids kept up by differences: stored sums of vectors that members are added to and taken from."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..lineage import cut
from ..sources.keyed import KeyedTable
from .centroids import KEY, centroids


def _sums(members: DataFrame, keys: list[str], weighted: bool) -> DataFrame:
    """(keys, dim, total, weight, n) of unit vectors, aggregated map-side."""
    unit = V.parse_vector(F.col("embedding"), "unit", is_array=True)
    w = F.greatest(F.coalesce("value_count", F.lit(1)), F.lit(1)).cast("double") if weighted else F.lit(1.0)
    rows = members.select(*keys, unit.alias("_v"), w.alias("_w")).filter(F.col("_v").isNotNull())
    return rows.groupBy(*keys, F.size("_v").alias("dim")).agg(
        vector_to_array(Summarizer.sum(array_to_vector("_v"), F.col("_w"))).alias("total"), F.sum("_w").alias("weight"), F.count("*").alias("n"))


class CentroidSums:
    """Sum of weight times unit vector, weight and members of each cluster (and length of vectors), in buckets by cluster.

    A change reads its own members and the buckets of their clusters, not the other members. A centroid is the unit sum; of
    several lengths that of most members counts. The medoid of a cluster is chosen anew, from its members, only where the
    centroid turned by more than a bound since the last choice, or the medoid went.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str] = KEY, weighted: bool = True, buckets: int = 64):
        self.spark, self.keys, self.weighted = spark, list(keys), weighted
        self.sums = KeyedTable(spark, f"{path.rstrip('/')}/sums", [*self.keys, "dim"], buckets, by=self.keys)
        self.medoids = KeyedTable(spark, f"{path.rstrip('/')}/medoids", self.keys, buckets)

    def change(self, added: DataFrame, removed: DataFrame | None = None) -> None:
        """Members (keys, value_count, embedding) that came and that went; a moved or reweighted member is in both."""
        new = _sums(added, self.keys, self.weighted)
        if removed is None and not self.sums.exists():
            self.sums.create(new)
            return
        parts = [new.withColumn("_sign", F.lit(1))]
        if removed is not None:
            parts.append(_sums(removed, self.keys, self.weighted).withColumn("_sign", F.lit(-1)))
        signed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        difference = cut(signed)
        if not self.sums.exists():
            self.sums.create(difference.drop("_sign").limit(0))

        def add_up(rows: DataFrame) -> DataFrame:
            both = rows.withColumn("_sign", F.lit(1)).unionByName(difference)
            sign = F.col("_sign").cast("double")
            each = both.select(*self.keys, "dim", F.transform("total", lambda x: x * sign).alias("total"),
                               (F.col("weight") * sign).alias("weight"), (F.col("n") * F.col("_sign")).alias("n"))
            return each.groupBy(*self.keys, "dim").agg(
                vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"), F.sum("weight").alias("weight"), F.sum("n").alias("n"))

        self.sums.update(difference, add_up)

    def centroids(self) -> DataFrame:
        """(keys, centroid, weight, n) of the clusters that have members."""
        best = F.max(F.struct("n", (-F.col("dim")).alias("d"), "total", "weight")).alias("b")
        rows = self.sums.read().filter("n > 0").groupBy(*self.keys).agg(best)
        return rows.select(*self.keys, V.l2_normalize(F.col("b.total")).alias("centroid"), "b.weight", "b.n")

    def stale(self, bound: float = 0.01, gone: DataFrame | None = None) -> DataFrame:
        """Keys of the clusters without a medoid, whose centroid turned by more than ``bound`` (1 - cosine), or whose medoid
        is among ``gone`` (keys, raw_label)."""
        now = self.centroids()
        if not self.medoids.exists():
            return now.select(*self.keys)
        known = self.medoids.read()
        if gone is not None:
            lost = gone.select(*self.keys, F.col("raw_label").alias("medoid_label")).distinct()
            known = known.join(lost, [*self.keys, "medoid_label"], "left_anti")
        turned: Column = F.lit(1.0) - V.dot(F.col("centroid"), F.col("chosen_for"))
        moved = now.join(known.select(*self.keys, "chosen_for"), self.keys, "left")
        same = F.coalesce((F.size("centroid") == F.size("chosen_for")) & (turned <= bound), F.lit(False))
        return moved.filter(~same).select(*self.keys)

    def choose(self, members: DataFrame, bound: float = 0.01, gone: DataFrame | None = None) -> DataFrame:
        """Choose the medoids of the stale clusters from their members; returns (keys, medoid_label) of those."""
        wanted = cut(self.stale(bound, gone))
        found = centroids(members.join(wanted, self.keys, "left_semi"), "backfill" if self.weighted else "weekly", self.keys)
        chosen = cut(found.join(self.centroids().select(*self.keys, F.col("centroid").alias("chosen_for")), self.keys).select(
            *self.keys, "medoid_label", "chosen_for"))
        self.medoids.upsert(chosen)
        return chosen.select(*self.keys, "medoid_label")
