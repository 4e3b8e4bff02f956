"""Embedding of distinct texts, with a cache of vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.embedtext import embedding_text
from ..functions.vectors import l2_normalize
from .vector_mean import mean_vectors

# A provider turns a series of texts into a list of equally long vectors.
Provider = Callable[[pd.Series], list]


def hash_vector(text: Column, dim: int = 384) -> Column:
    """Deterministic values from repeated SHA-256 of the text, a byte each; needs no model and no Python."""
    first = F.struct(F.sha2(F.encode(text, "UTF-8"), 256).alias("last"), F.lit("").alias("all"))

    def step(acc: Column, _: Column) -> Column:
        digest = F.sha2(F.unhex(acc["last"]), 256)
        return F.struct(digest.alias("last"), F.concat(acc["all"], digest).alias("all"))

    digits = F.aggregate(F.sequence(F.lit(1), F.lit(-(-dim // 32))), first, step, lambda acc: acc["all"])
    # A list of the bytes, so that the digests are computed once and not for each value.
    return F.transform(
        F.slice(F.regexp_extract_all(digits, F.lit("(..)"), F.lit(1)), 1, dim),
        lambda x: F.conv(x, 16, 10).cast("double") / 255.0 - 0.5)


def embed(
    df: DataFrame, text_col: str, provider: Provider | None, dim: int, out: str = "embedding"
) -> DataFrame:
    """Unit vector per text: by hash natively, or each distinct text once in Arrow batches, joined back.

    Without a provider the vectors are those of ``hash_vector``.
    """
    if provider is None:
        return df.withColumn(out, F.when(F.col(text_col).isNotNull(), l2_normalize(hash_vector(F.col(text_col), dim))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = np.asarray(provider(b["text"]), dtype=np.float64).reshape(len(b), -1)
            if len(b) and found.shape[1] != dim:
                raise ValueError(f"provider gave {found.shape[1]} dimensions, expected {dim}")
            length = np.linalg.norm(found, axis=1, keepdims=True)
            unit = found / np.where(length > 0, length, 1.0)
            yield pd.DataFrame({"text": b["text"], out: list(unit)})

    texts = df.select(F.col(text_col).alias("text")).filter("text IS NOT NULL").distinct()
    found = texts.mapInPandas(run, f"text string, {out} array<double>")
    return df.join(found.withColumnRenamed("text", text_col), text_col, "left")


def cached_embeddings(
    labels: DataFrame, cache: DataFrame, key: str, provider: Provider | None, dim: int,
    mode: str = "field_label", style: str = "cluster",
) -> DataFrame:
    """Vectors of the cache where present, embedding only the missing labels.

    ``from_cache`` tells which is which, so that a caller can append the new ones.
    """
    on = ["field_name", "raw_label"]
    have = cache.filter(F.col("cache_key") == key).select(*on, "embedding")
    hit = labels.join(have, on, "left")
    found = hit.filter(F.col("embedding").isNotNull()).withColumn("from_cache", F.lit(True))
    text = embedding_text(F.col("field_name"), F.col("raw_label"), mode, style)
    missing = hit.filter(F.col("embedding").isNull()).drop("embedding").withColumn("_text", text)
    made = embed(missing, "_text", provider, dim).drop("_text").withColumn("from_cache", F.lit(False))
    return found.unionByName(made)


def remove_field_bias(df: DataFrame, field: str = "field_name", vec: str = "v") -> DataFrame:
    """Subtract from each vector its projection on the mean direction of its field.

    Fields with one row or a mean of zero are only normalized.
    """
    means = mean_vectors(df, [field], vec).select(
        field, l2_normalize(F.col("mean")).alias("_dir"), F.col("n").alias("_n"),
        F.sqrt(F.aggregate("mean", F.lit(0.0), lambda a, x: a + x * x)).alias("_len"),
    )
    along = F.aggregate(F.zip_with(vec, "_dir", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    joined = df.join(means, field).withColumn("_along", along)
    freed = F.zip_with(vec, "_dir", lambda a, b: a - F.col("_along") * b)
    use = (F.col("_n") >= 2) & (F.col("_len") >= 1e-10)
    return joined.withColumn(
        vec, l2_normalize(F.when(use, freed).otherwise(F.col(vec)))
    ).drop("_dir", "_n", "_len", "_along")


def cluster_vector_from_labels(
    clusters: DataFrame, labels: DataFrame, vec: str = "v", dim: int = 64
) -> DataFrame:
    """Count-weighted unit mean of the label vectors of each cluster, zeros when it has none."""
    keys = ["field_name", "cluster_id"]
    weighted = labels.withColumn("_w", F.coalesce("value_count", F.lit(1)))
    means = mean_vectors(weighted, keys, vec, "_w").select(
        *keys, l2_normalize(F.col("mean")).alias("label_vector"), F.col("n").alias("label_rows")
    )
    zeros = F.array_repeat(F.lit(0.0), dim)
    return clusters.join(means, keys, "left").withColumns(
        {
            "label_vector": F.coalesce("label_vector", zeros),
            "label_rows": F.coalesce("label_rows", F.lit(0)),
        }
    )
