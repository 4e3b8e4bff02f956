"""Mean vectors per key, aggregated inside the JVM with map-side partial sums."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_vectors(
    df: DataFrame, keys: list[str], vec: str, weight: str | None = None
) -> DataFrame:
    """Weighted mean of equally long vectors per key: columns ``keys``, ``mean``, ``n``.

    A hot key costs one partial vector per map task, never its rows in one task.
    """
    ml = array_to_vector(F.col(vec))
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    return (
        df.groupBy(*keys)
        .agg(Summarizer.mean(ml, w).alias("m"), F.count("*").alias("n"))
        .withColumn("mean", vector_to_array("m"))
        .drop("m")
    )
