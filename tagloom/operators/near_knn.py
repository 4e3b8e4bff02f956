"""Approximate neighbours from random-projection buckets, for groups too large for the exact search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..lineage import cut
from .blocks import BLOCK_ROWS, _knn_columns, best_targets, merge_topk

SEED = 17


def _planes(table: int, bits: int, dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, table]).normal(size=(bits, dim))


def _bucket_of(v: Column, planes: np.ndarray) -> tuple[Column, Column]:
    """(bucket, margins): the signs of the projections as a number, and the projections."""
    margins = F.array(*[V.dot(v, F.array(*[F.lit(float(x)) for x in p])) for p in planes])
    signs = [F.when(F.get(F.col("margins"), F.lit(i)) > 0, F.lit(1 << i)).otherwise(F.lit(0)) for i in range(len(planes))]
    total = signs[0]
    for s in signs[1:]:
        total = total + s
    return total, margins


def approximate_knn(
    df: DataFrame, on: list[str], row_id: str, vec: str, k: int, tables: int = 6, probes: int = 4,
    min_sim: float = -1.0, bucket_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``k`` near neighbours of unit vectors inside ``on``, most of them the nearest ones; ties by id.

    In each of ``tables`` rounds rows are dealt to buckets by the signs of as many random projections as bring a bucket of
    the largest group down to about ``bucket_rows``; a row meets its own bucket and the ``probes - 1`` it would be in if its
    least certain signs were turned. Buckets are multiplied in blocks and rounds are merged, so a round costs about
    ``probes * bucket_rows`` products a row instead of all. Recall depends on the data; more tables or probes raise it, and
    ``knn`` is exact. The signs come from a fixed seed, so results repeat.
    """
    rows = cut(df.select(*on, F.col(row_id).cast("string").alias("rid"), V.as_double(F.col(vec)).alias("v")).filter(F.col("v").isNotNull()))
    head = rows.agg(F.max(F.size("v")).alias("dim"), F.count("*").alias("n")).first()
    if not head["n"]:
        return _knn_columns(merge_topk(best_targets(rows, rows, on, k, ("rid", "v", None), ("rid", "v", None)), [*on, "q_id"], k), on, k)
    largest = rows.groupBy(*on).count().agg(F.max("count")).first()[0]
    bits = min(30, max(1, int(np.ceil(np.log2(max(2, largest / bucket_rows))))))
    flips = [0, *(1 << i for i in range(min(bits, probes - 1)))]
    found = None
    for table in range(tables):
        planes = _planes(table, bits, head["dim"])
        bucket, margins = _bucket_of(F.col("v"), planes)
        dealt = cut(rows.withColumn("margins", margins).withColumn("bucket", bucket).select(
            *on, "rid", "v", "bucket",
            F.array_sort(F.transform("margins", lambda m, i: F.struct(F.abs(m).alias("a"), i.alias("i")))).getField("i").alias("least_certain")))
        turned = F.array(*[F.lit(0), *[F.call_function("shiftleft", F.lit(1), F.get("least_certain", F.lit(i))) for i in range(len(flips) - 1)]])
        asked = dealt.select(*on, "rid", "v", F.explode(F.transform(turned, lambda t: F.col("bucket").bitwiseXOR(t))).alias("bucket"))
        # the row itself is among its targets, so one more is asked for
        best = best_targets(asked, dealt.select(*on, "bucket", "rid", "v"), [*on, "bucket"], k + 1, ("rid", "v", None), ("rid", "v", None), min_sim=min_sim)
        part = best.filter((F.col("rank") <= k + 1) & (F.col("q_id") != F.col("t_id"))).select(*on, "q_id", "t_id", "sim", "conflict")
        found = part if found is None else found.unionByName(part)
    return _knn_columns(merge_topk(found.dropDuplicates([*on, "q_id", "t_id"]), [*on, "q_id"], k), on, k)
