"""Tables laid out by day, of which a window reads its days."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .io import compute_window, window_rows

DAY = "_day"


def write_days(df: DataFrame, path: str, times: list[str], mode: str = "append") -> None:
    """Append the rows in folders by the day of the first of the times that is there; with ``overwrite`` the days written are replaced."""
    day = F.to_date(F.coalesce(*times))
    df.withColumn(DAY, day).repartition(DAY, F.pmod(F.xxhash64(*times), F.lit(8))).write.partitionBy(DAY).option(
        "partitionOverwriteMode", "dynamic").mode(mode).parquet(path)


def read_days(spark: SparkSession, path: str, times: list[str], start=None, end=None, lookback: timedelta = timedelta(hours=1),
              reject_empty: bool = True) -> DataFrame:
    """Rows of ``write_days`` in the window; only its days, and those beside them for other time zones, are read."""
    begin, stop = compute_window(start, end, lookback, reject_empty)
    rows = spark.read.parquet(path)
    one = timedelta(days=1)
    near = F.col(DAY).between(F.lit((begin - one).date()), F.lit((stop + one).date()))
    return window_rows(rows.filter(near), times, begin, stop, reject_empty=False).drop(DAY)
