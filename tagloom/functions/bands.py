"""Named bands of scores and sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def similarity_band(score: Column, same_field: Column, is_anomaly: Column) -> Column:
    return (
        F.when(score.isNull(), "not computed")
        .when(is_anomaly & (score >= 0.82), "anomaly recovery candidate")
        .when(same_field & (score >= 0.9), "merge candidate")
        .when(score >= 0.82, "semantic neighbor")
        .when(score >= 0.72, "weak semantic neighbor")
        .otherwise("distant neighborhood")
    )


def search_confidence(score: Column) -> Column:
    return (
        F.when(score >= 0.75, "confident").when(score >= 0.60, "possible").otherwise("weak")
    )


def label_confidence(score: Column) -> Column:
    return (
        F.when(score >= 0.55, "Confident").when(score >= 0.30, "Possible").otherwise("Weak")
    )


def size_bucket(size: Column) -> Column:
    return (
        F.when(size == 1, "1")
        .when(size <= 3, "2–3")
        .when(size <= 5, "4–5")
        .when(size <= 10, "6–10")
        .when(size <= 25, "11–25")
        .when(size <= 50, "26–50")
        .when(size <= 100, "51–100")
        .otherwise("100+")
    )


def anomaly_type(size: Column) -> Column:
    return (
        F.when(size <= 2, "noise")
        .when(size <= 5, "threshold_failure")
        .when(size > 20, "emerging")
        .otherwise("semantic_outlier")
    )
