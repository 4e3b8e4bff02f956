"""A written index of unit vectors: cells as partitions, each with its centre and radius, searched without loss."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..lineage import cut
from .blocks import _side, best_targets, pack, salts_for, small_batches

CELL = "cell"
#: Rows of a file; a cell that holds more is many files.
FILE_ROWS = 1 << 18
#: Nearest cells of a query that are searched before the bound is known.
PROBE = 2
ALL = 1 << 30


class VectorIndex:
    """Rows in folders by cell, a cell being the rows nearest to one pivot.

    A row at angle a from a query lies in a cell whose pivot is at most a plus the cell's radius away, so a search reads only
    the cells that can hold an answer: by partition pruning, and none that matters is left out. New rows go to the cells
    there are; a radius only grows, so nothing is rebuilt. Radii are written before the rows they are for.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.rows_path, self.pivots_path, self.radii_path = (f"{self.path}/{x}" for x in ("rows", "pivots", "radii"))

    @classmethod
    def build(cls, df: DataFrame, path: str, row_id: str, vec: str, cells: int | None = None) -> VectorIndex:
        """Index all rows with a vector that is not zero; ``cells`` is about the root of the rows unless given.

        Pivots are the rows with the smallest hash of their id, spread over the data as its rows are; they are the only
        sample, and only the order of work depends on it. ``row_id`` is unique and all vectors are of one length.
        """
        self = cls(df.sparkSession, path)
        rows = cut(self._units(df, row_id, vec))
        n = cells or max(1, round(rows.count() ** 0.5))
        first = rows.dropDuplicates(["v"]).orderBy(F.xxhash64("rid"), "rid").limit(n)
        numbered = first.select(F.row_number().over(Window.orderBy(F.xxhash64("rid"), "rid")).cast("int").alias(CELL), "v")
        numbered.write.parquet(self.pivots_path)
        self._add(rows)
        return self

    def _units(self, df: DataFrame, row_id: str, vec: str) -> DataFrame:
        v = V.l2_normalize(V.as_double(F.col(vec)))
        rows = df.select(F.col(row_id).cast("string").alias("rid"), v.alias("v"), F.struct(*[df[c] for c in df.columns if c != vec]).alias("row"))
        return rows.filter(F.col("v").isNotNull() & (V.dot(F.col("v"), F.col("v")) > 0.5))

    def insert(self, df: DataFrame, row_id: str, vec: str) -> None:
        """Add rows to the cells there are."""
        self._add(cut(self._units(df, row_id, vec)))

    def _add(self, rows: DataFrame) -> None:
        pivots = self.spark.read.parquet(self.pivots_path)
        near = best_targets(rows, pivots, [], 1, ("rid", "v", None), (CELL, "v", None)).filter("rank = 1")
        near = cut(near.select(F.col("q_id").alias("rid"), F.col("t_id").cast("int").alias(CELL), "sim"))
        radii = cut(near.groupBy(CELL).agg(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.min("sim") - 1e-9))).alias("radius"), F.count("*").alias("n")))
        radii.coalesce(1).write.mode("append").parquet(self.radii_path)
        part = F.pmod(F.xxhash64("rid"), F.ceil(F.col("n") / FILE_ROWS))
        placed = rows.join(near.join(radii, CELL).select("rid", CELL, part.alias("_part")), "rid")
        placed.repartition(CELL, "_part").drop("_part").write.mode("append").partitionBy(CELL).parquet(self.rows_path)

    def cells(self) -> DataFrame:
        """(cell, v, radius, n) of the cells that hold rows."""
        radii = self.spark.read.parquet(self.radii_path).groupBy(CELL).agg(F.max("radius").alias("radius"), F.sum("n").alias("n"))
        return self.spark.read.parquet(self.pivots_path).join(radii, CELL)

    def rows(self, cells: list[int] | None = None) -> DataFrame:
        """The rows of the cells, all unless given; others are not read."""
        rows = self.spark.read.parquet(self.rows_path)
        return rows if cells is None else rows.filter(F.col(CELL).isin(cells))

    def reachable(self, queries: DataFrame) -> DataFrame:
        """(q_id, cell) of the cells that can hold a row of similarity ``needed`` or more to the query; a written table.

        ``queries``: q_id (string), q (unit vector), needed. Queries and centres are multiplied in blocks.
        """
        q = queries.select("q_id", F.concat("q", F.array(F.col("needed"))).alias("v"))
        t = self.cells().select(F.col(CELL).cast("string").alias("c_id"), F.concat("v", F.array("radius")).alias("v"))
        packed = cut(pack(q, [], "q_id", "v"))
        parts = salts_for(packed.count())
        qb = _side(packed, "q").withColumn("salt", F.pmod(F.hash("q_block"), F.lit(parts)))
        tb = _side(pack(t, [], "c_id", "v"), "t").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        with small_batches(self.spark):
            return cut(qb.join(tb, ["dim", "salt"]).select("dim", "q_ids", "q_vecs", "t_ids", "t_vecs").mapInPandas(_in_reach, f"q_id string, {CELL} int"))

    def search(self, queries: DataFrame, row_id: str, vec: str, k: int | None = None, min_sim: float | None = None) -> DataFrame:
        """(q_id, row, sim, rank) of the rows nearest to each query: the ``k`` best, those of ``min_sim`` or more, or both.

        Exact; ties by row id. Top-k searches look into PROBE cells of each query first, and then only into the cells whose
        bound reaches the k-th similarity found there. Queries without a direction find nothing.
        """
        if k is None and min_sim is None:
            raise ValueError("set k, min_sim or both")
        q = cut(self._units(queries, row_id, vec).select(F.col("rid").alias("q_id"), F.col("v").alias("q")))
        least = -1.0 if min_sim is None else min_sim
        if k is None:
            found = self._best(q, self.reachable(q.withColumn("needed", F.lit(least))), ALL, least)
        else:
            near = best_targets(q, self.cells().select(CELL, "v"), [], PROBE, ("q_id", "q", None), (CELL, "v", None))
            probed = cut(near.filter(F.col("rank") <= PROBE).select("q_id", F.col("t_id").cast("int").alias(CELL)))
            first = cut(self._best(q, probed, k, least))
            kth = first.groupBy("q_id").agg(F.count("*").alias("n"), F.min("sim").alias("worst")).filter(F.col("n") >= k)
            needed = F.greatest(F.lit(least), F.coalesce("worst", F.lit(least)))
            rest = self.reachable(q.join(kth, "q_id", "left").select("q_id", "q", needed.alias("needed")))
            found = first.unionByName(self._best(q, cut(rest.join(probed, ["q_id", CELL], "left_anti")), k, least))
        w = Window.partitionBy("q_id").orderBy(F.col("sim").desc(), "rid")
        found = found.withColumn("rank", F.row_number().over(w))
        found = cut(found if k is None else found.filter(F.col("rank") <= k))
        kept = self.rows([r[0] for r in found.select(CELL).distinct().collect()])  # at most as many numbers as cells
        return found.join(kept.select("rid", CELL, "row"), ["rid", CELL]).select("q_id", "row", "sim", "rank")

    def _best(self, q: DataFrame, wanted: DataFrame, k: int, least: float) -> DataFrame:
        """(q_id, rid, cell, sim): the best rows of each wanted (q_id, cell), by products of blocks of one cell."""
        cells = [r[0] for r in wanted.select(CELL).distinct().collect()]
        asked = q.join(wanted, "q_id")
        best = best_targets(asked, self.rows(cells).select(CELL, "rid", "v"), [CELL], k, ("q_id", "q", None), ("rid", "v", None), min_sim=least)
        return best.filter(F.col("rank") <= k).select("q_id", F.col("t_id").alias("rid"), CELL, "sim")


def _in_reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pairs in batches:
        for p in pairs.itertuples(index=False):
            q, t = (np.asarray(x, dtype=np.float64).reshape(-1, p.dim) for x in (p.q_vecs, p.t_vecs))
            between = np.arccos(np.clip(q[:, :-1] @ t[:, :-1].T, -1.0, 1.0))
            best = np.cos(np.maximum(0.0, between - t[None, :, -1] - 1e-6))
            at, cell = np.nonzero(best >= q[:, -1:] - 1e-8)
            yield pd.DataFrame({"q_id": np.asarray(p.q_ids)[at], CELL: np.asarray(p.t_ids).astype(np.int32)[cell]})


def temporary_index(df: DataFrame, folder: str, row_id: str, vec: str, cells: int | None = None) -> VectorIndex:
    """An index under a new name in ``folder``."""
    return VectorIndex.build(df, f"{folder}/index-{uuid.uuid4().hex}", row_id, vec, cells)
